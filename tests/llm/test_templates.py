"""Url verdicts against a plain tree of dictionaries."""

import random
import re

import pytest
from pyspark.sql import functions as F

from bayline.llm import templates
from bayline.llm.queries import RULES

RULED = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host) :]).group()
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def ruled(host, path):
    fits = [(h + p, v) for h, p, v in RULED if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits, key=lambda f: len(f[0]), default=(None, None))


def chi(a, b, c, d):
    margins = (a + b) * (c + d) * (a + c) * (b + d)
    return (a + b + c + d) * (a * d - b * c) ** 2 / margins if margins else 0


def plain_verdicts(urls):
    rows = [(*parts(u), *ruled(*parts(u))) for u in urls]
    blocked, labelled = sum(r[3] == "block" for r in rows), sum(r[3] is not None for r in rows)
    prior, m = blocked / labelled if labelled else 0, templates.STRENGTH
    template, share = {}, {}

    def grow(pages, depth, name, up):
        """pages of one node: (index, segments, label)."""
        below = {}
        for page in pages:
            if len(page[1]) == depth:
                template[page[0]], share[page[0]] = name, up
            else:
                below.setdefault(page[1][depth], []).append(page)

        def counts(group):
            n, on = len(group), sum(len(p[1]) > depth + 1 for p in group)
            return sum(p[2] == "block" for p in group), sum(p[2] == "allow" for p in group), on, n - on

        every = [p for group in below.values() for p in group]
        branches = {}
        for segment, group in below.items():
            own, rest = counts(group), counts([p for p in every if p[1][depth] != segment])
            differs = chi(own[0], own[1], rest[0], rest[1]) + chi(own[2], own[3], rest[2], rest[3])
            often = len(group) >= templates.LEAST and len(group) >= templates.SHARE * len(every)
            stays = len(group) == len(every) or (often and differs > templates.DIFFERENT)
            branches.setdefault(segment if stays else "*", []).extend(group)
        for label, group in branches.items():
            b, a, _, _ = counts(group)
            grow(group, depth + 1, f"{name}/{label}", (b + m * up) / (a + b + m))

    hosts = {}
    for i, (host, path, _, label) in enumerate(rows):
        shape = re.sub("[0-9]+", "{n}", path)
        hosts.setdefault(host, []).append((i, shape[1:].split("/", templates.LEVELS - 1) if shape else [], label))
    for pages in hosts.values():
        b, a = (sum(p[2] == v for p in pages) for v in ("block", "allow"))
        grow(pages, 0, "", (b + m * prior) / (a + b + m))
    learnt = ["block" if share[i] >= templates.REJECT else "allow" for i in range(len(urls))]
    return [(r[0], r[1], r[2], r[3] or learnt[i], template[i], pytest.approx(share[i])) for i, r in enumerate(rows)]


def found(spark, urls):
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    rows = sorted(templates.judged(pages, RULES).collect())
    assert [r.page_id for r in rows] == list(range(len(urls)))
    return [tuple(r)[1:] for r in rows]


def test_verdicts_match_a_plain_tree(spark):
    rng = random.Random(7)
    urls = []
    for _ in range(1500):
        host = rng.choice(["a.com", "A.com", "b.example.org", "example.org", "c.net", "d.e.com", "com", "xcom"])
        first = rng.choice(["de", "fr", "en", "es", "shop", "shop", f"user{rng.choice('abcdefgh')}", f"x{rng.random()}"])
        tail = rng.choice(["", "/", f"/{rng.randrange(10**6)}", f"/{rng.randrange(99)}.html", "/a/b/c/d/e", f"/{rng.choice('pq')}/{rng.randrange(9)}/"])
        if first == "shop" and host == "a.com" and rng.random() < 0.8:
            tail = "/item/" + rng.choice(["red", "blue", "green"])
        urls.append(f"{rng.choice(['http', 'HTTPS'])}://{host}/{first}{tail}{rng.choice(['', '?q=/x', '#top/y'])}")
    got, wanted = found(spark, urls), plain_verdicts(urls)
    assert got == wanted
    assert len({t for *_, t, _ in wanted}) > 15 and any("/de/" in t for *_, t, _ in wanted)
    assert any(v == "block" and r is None for _, _, r, v, _, _ in wanted) or all(r[3] == "allow" for r in wanted if r[2] is None)


def test_odd_urls(spark):
    urls = [
        None, "", "no scheme", "://", "http://", "http://ORG", "http://org/", "http://x.ORG/es/", "http://www.example.org/es/1", "http://example.org/en/12",
        "http://example.org/en/2", "http://notexample.org/es/", "http://a.com?/fr/", "http://a.com#/de/", "http://com/de/", "http://ÄÖ.com/fr/é", "a://b://c/d",
        "http://a.com/" + "x/" * 20_000, "http://a.com/" + "9" * 50_000, "http://a.net//", "http://a.net/{n}/*", "http://a.net/\n/de/", "http://example.org:80/",
    ]
    urls += urls
    assert found(spark, urls) == plain_verdicts(urls)
    pages = spark.createDataFrame([(None, "http://a.com/fr/", "x", "y"), (None, None, None, None)], "page_id long, url string, host string, template string")
    assert [tuple(r)[:5] for r in templates.judged(pages, RULES).orderBy("host").collect()] == [
        (None, "", "", None, "allow"),
        (None, "a.com", "/fr/", "com/fr/", "allow"),
    ]
    assert templates.judged(pages.limit(0), RULES).count() == 0
    unlabelled = templates.judged(spark.createDataFrame([(1, "http://a.net/de/")], "page_id long, url string"), RULES).first()
    assert (unlabelled.verdict, unlabelled.share) == ("allow", 0.0)


def test_templates_learn_held_out_pages(spark):
    rng = random.Random(3)
    urls = [f"http://h{rng.randrange(4)}.com/{rng.choice(['de', 'fr', 'en'])}/{rng.randrange(10**6)}" for _ in range(2000)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    rows = templates.judged(pages, RULES, F.col("page_id") % 3 != 1).filter("page_id % 3 = 1 AND rule IS NOT NULL").collect()
    assert all((r.share >= templates.REJECT) == (r.verdict == "block") for r in rows)
    assert {r.verdict for r in rows} == {"block", "allow"}


def test_a_rejected_template_blocks_urls_of_no_rule(spark):
    urls = [f"http://bad.com/de/{i}" for i in range(40)] + ["http://bad.com/xx/1", "http://good.com/xx/1"] + [f"http://good.com/fr/{i}" for i in range(40)]
    got = found(spark, urls)
    assert got == plain_verdicts(urls)
    assert (got[40][2], got[40][3]) == (None, "block") and got[41][3] == "allow"
