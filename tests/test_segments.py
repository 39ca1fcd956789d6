import numpy as np
import pytest
from pyspark.sql import functions as F

from bayline.operators import clustering, segments

PROFILE = "cluster_id int, customers long, avg_visits double, delay_rate double, avg_csat double, complaint_rate double"

# fixed values: two published cluster profiles and the names they were given
FIRST = [
    (0, 4154, 2.144198, 0.310437, 3.426489, 0.163878),
    (1, 9744, 4.048235, 0.806787, 3.002741, 0.345241),
    (2, 7644, 1.736787, 0.984812, 2.855976, 0.285180),
    (3, 4846, 7.838630, 0.771889, 3.033892, 0.364452),
]
FIRST_NAMES = {
    0: "Satisfied Loyal Customers",
    1: "Occasional Customers",
    2: "Delay-Sensitive Customers",
    3: "High-Engagement Customers",
}
REFINED = [
    (0, 7480, 6.864840, 0.776935, 3.107199, 0.324422),
    (1, 7899, 2.189011, 0.958686, 3.366582, 0.042489),
    (2, 5342, 2.569262, 0.386635, 3.690047, 0.070227),
    (3, 5667, 3.043939, 0.876974, 1.849118, 0.856429),
]
REFINED_NAMES = {
    0: "Highly Engaged Customers",
    1: "High-Risk Delay Customers",
    2: "Satisfied / Stable Customers",
    3: "At-Risk Experience Customers",
}


def names(df):
    return {r.cluster_id: r.segment_name for r in df.collect()}


def test_published_profiles_get_their_names(spark):
    first = spark.createDataFrame(FIRST, PROFILE)
    assert names(segments.name_clusters_v1(first)) == FIRST_NAMES
    refined = spark.createDataFrame(REFINED, PROFILE)
    assert names(segments.name_clusters_v2(refined)) == REFINED_NAMES
    for named, actions in (
        (segments.name_clusters_v1(first), segments.CLUSTER_ACTIONS_V1),
        (segments.name_clusters_v2(refined), segments.CLUSTER_ACTIONS_V2),
    ):
        assert segments.with_actions(named, actions).filter("recommended_action IS NULL").count() == 0


def test_names_stay_distinct_when_one_cluster_leads_in_everything(spark):
    # cluster 1 has the longest delays and the most visits
    rows = [(0, 5, 1.0, 0.1, 4.5, 0.1), (1, 5, 9.0, 0.9, 2.0, 0.1), (2, 5, 3.0, 0.5, 3.0, 0.1), (3, 5, 2.0, 0.4, 3.5, 0.1)]
    got = names(segments.name_clusters_v2(spark.createDataFrame(rows, PROFILE)))
    assert len(set(got.values())) == 4
    assert got[1] == segments.HIGH_RISK and got[2] == segments.ENGAGED


def test_v1_gives_a_later_title_to_nobody(spark):
    rows = [(0, 5, 9.0, 0.9, 4.5, 0.1), (1, 5, 1.0, 0.1, 2.0, 0.1), (2, 5, 1.0, 0.2, 3.0, 0.1)]
    got = names(segments.name_clusters_v1(spark.createDataFrame(rows, PROFILE)))
    assert got == {0: "Delay-Sensitive Customers", 1: "Occasional Customers", 2: "Occasional Customers"}


@pytest.fixture(scope="module")
def customers(spark):
    rng = np.random.default_rng(4)
    rows = [
        (i, int(rng.integers(1, 9)), float(rng.random()), float(rng.integers(2, 11) / 2), float(rng.random()))
        for i in range(200)
    ]
    return spark.createDataFrame(
        rows, "customer_id int, total_visits int, delay_rate double, avg_csat double, complaint_rate double"
    )


def test_rules_match_a_plain_loop(customers):
    rows = customers.collect()

    def q(name, p):
        return np.quantile([r[name] for r in rows], p)

    t = {n: (q(n, 0.25), q(n, 0.75)) for n in ("delay_rate", "avg_csat", "complaint_rate", "total_visits")}

    def expected(r):
        if r.avg_csat <= t["avg_csat"][0] and (
            r.delay_rate >= t["delay_rate"][1] or r.complaint_rate >= t["complaint_rate"][1]
        ):
            return "At-Risk"
        if r.avg_csat >= t["avg_csat"][1] and r.delay_rate <= t["delay_rate"][0]:
            return "Loyal / Satisfied"
        return "High-Service-Need" if r.total_visits >= t["total_visits"][1] else "Occasional / Low-Engagement"

    got = {r.customer_id: r.segment for r in segments.rule_segments(customers).collect()}
    assert got == {r.customer_id: expected(r) for r in rows}


def test_at_risk_list_and_findings(customers, spark):
    listed = segments.at_risk_list(segments.rule_segments(customers)).collect()
    order = [(-r.complaint_rate, -r.delay_rate, r.avg_csat) for r in listed]
    assert order == sorted(order) and listed
    profile = spark.createDataFrame(
        [("a", 3, 0.1, 0.9), ("b", 9, 0.5, 0.2), ("c", 9, 0.5, 0.1)],
        "segment string, customers int, complaint_rate double, delay_rate double",
    )
    got = {r.finding: r.segment for r in segments.key_findings(profile).collect()}
    assert got == {
        "Largest segment": "b", "Highest complaint segment": "b", "Highest delay-rate segment": "a"
    }


def test_standardize(spark):
    df = spark.createDataFrame([(1, 1.0, 5.0), (2, 3.0, 5.0)], "k int, x double, flat double")
    got = {r.k: (r.x, r.flat) for r in clustering.standardize(df, ["x", "flat"]).collect()}
    assert got == {1: (-1.0, 0.0), 2: (1.0, 0.0)}


def test_silhouette_against_all_pairs(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(60, 3)) + np.repeat(np.arange(3), 20)[:, None]
    label = np.repeat(np.arange(3), 20)
    label[0] = 7  # a cluster with a single row
    d = ((x[:, None] - x[None]) ** 2).sum(-1)
    scores = []
    for i in range(60):
        own = (label == label[i]) & (np.arange(60) != i)
        if not own.any():
            scores.append(0.0)
            continue
        b = min(d[i, label == other].mean() for other in set(label) - {label[i]})
        a = d[i, own].mean()
        scores.append((b - a) / max(a, b))
    df = spark.createDataFrame([(x[i].tolist(), int(label[i])) for i in range(60)], "x array<double>, l int")
    n, got = clustering.silhouette(df.repartition(3), "x", "l").first()
    assert n == 60 and got == pytest.approx(np.mean(scores), rel=1e-9)
    far = df.withColumn("x", F.transform("x", lambda v: v + 1e8))
    assert clustering.silhouette(far, "x", "l").first()[1] == pytest.approx(got, rel=1e-5)


def test_kmeans_finds_separated_groups(spark):
    rng = np.random.default_rng(8)
    centers = np.array([[0, 0], [0, 9], [9, 0], [9, 9]])
    rows = [
        (i, *map(float, centers[i % 4] + rng.normal(scale=0.4, size=2))) for i in range(200)
    ]
    df = spark.createDataFrame(rows, "k int, x double, y double")
    got = clustering.kmeans_fit(df, "k", ["x", "y"], 4, restarts=3)
    pairs = got.select((F.col("k") % 4).alias("group"), "cluster_id").distinct().collect()
    assert got.count() == 200 and len(pairs) == 4
    search = clustering.k_search(df, "k", ["x", "y"], [2, 4], restarts=3).collect()
    assert [(r.k, r.best) for r in search] == [(2, False), (4, True)]


def test_kmeans_keeps_its_own_vectors(spark, monkeypatch):
    """A table that is cached itself would be decoded twice in every pass of a run."""
    from pyspark.ml.clustering import KMeans

    from bayline.operators import clustering

    cached = []

    class Noted(KMeans):
        def fit(self, dataset, params=None):
            cached.append(dataset.storageLevel.useMemory)
            return super().fit(dataset, params)

    monkeypatch.setattr(clustering, "KMeans", Noted)
    df = spark.createDataFrame([(i, float(i % 2 * 9), float(i)) for i in range(20)], "k int, x double, y double")
    clustering.kmeans_fit(df, "k", ["x", "y"], k=2, restarts=2)
    assert cached == [False, False]
