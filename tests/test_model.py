import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from bayline.operators import model

NUMERIC, CATEGORICAL = ["x", "flat"], ["dealer"]


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(9)
    rows = []
    for i in range(400):
        x, dealer = float(rng.normal()), "abc"[int(rng.integers(3))]
        late = int(x + (dealer == "a") + rng.normal(scale=0.5) > 0.8)
        rows.append((i, None if i % 50 == 0 else x, 2.0, None if i % 40 == 0 else dealer, late))
    return spark.createDataFrame(rows, "k int, x double, flat double, dealer string, late int")


@pytest.fixture(scope="module")
def fitted(frame):
    return model.fit_logit(frame, "late", NUMERIC, CATEGORICAL)


def design(frame):
    rows = frame.orderBy("k").collect()
    x = np.array([np.nan if r.x is None else r.x for r in rows])
    x = np.where(np.isnan(x), np.nanmedian(x), x)
    dealers = [r.dealer for r in rows]
    mode = max(sorted({d for d in dealers if d}), key=dealers.count)
    dealers = [d or mode for d in dealers]
    columns = [(x - x.mean()) / x.std(), np.zeros(len(x))]
    columns += [np.array([float(d == level) for d in dealers]) for level in "abc"]
    return np.stack(columns, 1), np.array([r.late for r in rows], float)


def newton(features, y):
    """Minimum of |w|^2/2 + sum of weighted losses, intercept unpenalised."""
    weight = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (1 - y).sum()))
    a = np.hstack([features, np.ones((len(y), 1))])
    penalty = np.diag([1.0] * features.shape[1] + [0.0])
    w = np.zeros(a.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-a @ w))
        gradient = a.T @ (weight * (p - y)) + penalty @ w
        hessian = (a * (weight * p * (1 - p))[:, None]).T @ a + penalty
        w -= np.linalg.solve(hessian, gradient)
    return w


def test_coefficients_minimise_the_penalised_loss(frame, fitted):
    expected = newton(*design(frame))
    got = {r.feature: r.coefficient for r in model.coefficients(fitted, frame, NUMERIC).collect()}
    names = ["numeric__x", "numeric__flat", "categorical__dealer_a", "categorical__dealer_b", "categorical__dealer_c"]
    assert [got[n] for n in names] == pytest.approx(expected[:5], abs=2e-3)
    listed = [r.absolute_coefficient for r in model.coefficients(fitted, frame, NUMERIC).collect()]
    assert listed == sorted(listed, reverse=True)


def test_unknown_levels_and_missing_values_are_scored(spark, frame, fitted):
    new = spark.createDataFrame(
        [(1, 0.3, 2.0, "unseen", 0), (2, None, None, None, 0)],
        frame.schema.simpleString()[7:-1].replace(":", " "),
    )
    scored = model.score_and_band(fitted, new).collect()
    assert len(scored) == 2
    assert all(0 < r.delay_probability < 1 and r.risk_band in model.RISK_LABELS for r in scored)


def test_balanced_weights_sum_to_the_rows(frame):
    weights = model.balanced_weights(frame, "late")
    assert weights.agg(F.sum("weight")).first()[0] == pytest.approx(400)
    per_class = weights.groupBy("late").agg(F.sum("weight").alias("w")).collect()
    assert all(r.w == pytest.approx(200) for r in per_class)


def test_auc_equals_the_evaluator(frame, fitted):
    scored = fitted.transform(frame)
    exact = BinaryClassificationEvaluator(
        labelCol="late", rawPredictionCol="probability", numBins=0
    ).evaluate(scored)
    got = model.roc_auc(model.score(fitted, frame), "late", "delay_probability").first()[0]
    assert got == pytest.approx(exact, abs=1e-6) and got > 0.8


def test_published_confusion_counts(spark):
    counts = spark.createDataFrame([(3637, 862, 3992, 11432)], "tn long, fp long, fn long, tp long")
    report = {r.label: r for r in model.class_report_of(counts).collect()}
    assert report["1"].precision == pytest.approx(0.9298844965023588, rel=1e-12)
    assert report["1"].recall == pytest.approx(0.7411825726141079, rel=1e-12)
    assert report["1"].f1_score == pytest.approx(0.8248791399090843, rel=1e-12)
    assert report["0"].precision == pytest.approx(0.47673351684362303, rel=1e-12)
    assert report["accuracy"].precision == pytest.approx(0.7563619936756513, rel=1e-12)
    assert report["macro avg"].f1_score == pytest.approx(0.7123241345983417, rel=1e-12)
    assert report["weighted avg"].precision == pytest.approx(0.8275542120329188, rel=1e-12)
    assert report["weighted avg"].support == 19923


def test_metrics_without_positive_predictions(spark):
    df = spark.createDataFrame([(1, 0.2, 0), (0, 0.1, 0)], "y int, p double, hat int")
    got = {r.metric: r.value for r in model.binary_metrics(df, "y", "p", "hat").collect()}
    assert got == {"ROC-AUC": 1.0, "Precision": 0.0, "Recall": 0.0, "F1": 0.0}
    matrix = [tuple(r) for r in model.confusion(df, "y", "hat").collect()]
    assert matrix == [("Actual On-Time", 1, 0), ("Actual Delayed", 1, 0)]


def test_split_is_stable_and_covers_both_classes(frame):
    one = model.stratified_split(frame, "k", "late").select("k", "is_test")
    two = model.stratified_split(frame.repartition(7), "k", "late").select("k", "is_test")
    assert {tuple(r) for r in one.collect()} == {tuple(r) for r in two.collect()}
    shares = model.stratified_split(frame, "k", "late").groupBy("late").agg(
        F.avg(F.col("is_test").cast("int")).alias("s")
    )
    assert all(abs(r.s - 0.2) < 0.1 for r in shares.collect())


def test_mode_takes_the_smallest_of_equal_counts(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), ("c",), (None,)], "x string")
    assert model.mode_imputer(df, ["x"]).first().value == "a"


def test_a_model_scores_in_a_session_that_has_observed_a_write(spark):
    from pyspark.sql import Observation

    seen = Observation("rows")
    spark.range(5).observe(seen, F.count(F.lit(1)).alias("n")).write.format("noop").mode("overwrite").save()
    assert seen.get == {"n": 5}
    rows = [(i, float(i % 7), "ab"[i % 2], int(i % 3 == 0)) for i in range(60)]
    df = spark.createDataFrame(rows, "k INT, x DOUBLE, dealer STRING, late INT")
    fit = model.fit_logit(df, "late", ["x"], ["dealer"])
    assert model.score_and_band(fit, df).count() == 60
    assert not fit.stages[-1].hasSummary
