"""Verdicts on urls: given rules first, else path templates of the host that the rules' verdicts teach.

Each host has a tree of path segments. Runs of digits are one sign, so most ids are gone before anything is
counted; then all urls of a host and shape are one row. Level by level, a segment stays as it is if it is the only
one at its node, or if it is frequent there and differs from its siblings together: a chi-square test of labels
(blocked, allowed) and of structure (ends here, goes on). All others, rare ones and those that do not differ, are
one wildcard branch. A branch is tested against the sum of its siblings, not pair by pair, so a node costs as
much as it has branches.

A url that a rule fits is labelled by it. A template's share of blocked urls is smoothed towards its parent's,
(blocked + STRENGTH * parent's share) / (labelled + STRENGTH); the root of a host leans on the share of all hosts.
A template is rejected from ``REJECT`` on.

There are ``LEVELS`` levels; what follows the last one's slash is one segment, so no path is cut off. Counts are
combined before each shuffle; the joins add rows of unique keys to a streamed side, whose hot keys AQE splits.
One row, the labels of all hosts, comes to the driver. Rules are a short list, given as literals.

Defined results: a null url, or one without ``://``, has an empty host and path and the template of those.
Without any label every url is allowed unless a rule says otherwise. Repeated rows and null ids are judged like
others. Other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bayline.llm.common import prepare, stage

LEVELS = 4
#: A literal branch has so many urls at least, and this share of its node.
LEAST, SHARE = 5, 0.02
#: Chi-square with two degrees of freedom at one per cent.
DIFFERENT = 9.21
#: So many labels the parent's share counts for. Held-out pages of the given tables choose it and LEAST: a tenth more
#: of the blocked ones are found than with ten and ten, and no allowed one is rejected.
STRENGTH = 2.0
REJECT = 0.8
DIGITS, WILDCARD = "{n}", "*"


class Rule(NamedTuple):
    """For a host and its subdomains, where the path starts so."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def with_parts(pages: DataFrame) -> DataFrame:
    """page_id, host (A-Z lower-cased) and path of the url."""
    at = F.instr("url", "://")
    rest = F.when(at > 0, F.substring(F.col("url"), at + 3, F.char_length("url"))).otherwise("")
    rows = pages.select("page_id", F.coalesce(rest, F.lit("")).alias("rest"))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    host = F.translate(F.regexp_extract("rest", "^[^/?#]*", 0), upper, upper.lower())
    return rows.select("page_id", host.alias("host"), F.regexp_extract("rest", "^[^/?#]*([^?#]*)", 1).alias("path"))


def fitting(rules: Sequence[Rule], give: str) -> Column:
    """``name`` or ``verdict`` of the longest rule that fits host and path; null if none does."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((F.col("host") == rule.host) | F.col("host").endswith("." + rule.host)) & F.col("path").startswith(rule.path)
        found = F.when(fits, F.lit(getattr(rule, give))).otherwise(found)
    return found


def chi_square(a: Column, b: Column, c: Column, d: Column) -> Column:
    """Of the table (a, b / c, d); zero where a margin is empty."""
    margins = (a + b) * (c + d) * (a + c) * (b + d)
    return F.when(margins > 0, (a + b + c + d) * (a * d - b * c) * (a * d - b * c) / margins).otherwise(0.0)


def smoothed(blocked: Column, allowed: Column, parent: Column) -> Column:
    return (blocked + STRENGTH * parent) / (blocked + allowed + STRENGTH)


def labels_of(tree: DataFrame) -> DataFrame:
    """tree with child -> host, node, child, label: the child itself or the wildcard; counts; parent's share."""
    goes_on = F.when(F.col("onward"), F.col("n")).otherwise(0.0)
    counts = [F.sum(c).alias(c) for c in ("n", "blocked", "allowed")]
    each = tree.filter("child IS NOT NULL").groupBy("host", "node", "child")
    each = each.agg(*counts, F.sum(goes_on).alias("on"), F.first("share").alias("share"))
    whole = each.groupBy("host", "node").agg(*[F.sum(c).alias(f"all_{c}") for c in ("n", "blocked", "allowed", "on")])
    rows = each.join(whole, ["host", "node"])

    n, blocked, allowed, on = (F.col(c) for c in ("n", "blocked", "allowed", "on"))
    others = {c: F.col(f"all_{c}") - F.col(c) for c in ("n", "blocked", "allowed", "on")}
    differs = chi_square(blocked, allowed, others["blocked"], others["allowed"])
    differs += chi_square(on, n - on, others["on"], others["n"] - others["on"])
    stays = (others["n"] == 0) | ((n >= LEAST) & (n >= SHARE * F.col("all_n")) & (differs > DIFFERENT))
    label = F.when(stays, F.col("child")).otherwise(WILDCARD)
    return rows.select("host", "node", "child", label.alias("label"), "blocked", "allowed", "share")


def grown(tree: DataFrame, level: int) -> DataFrame:
    """The tree one level deeper: node and share of each shape; shapes that have ended keep theirs."""
    tree = tree.withColumn("child", F.get("segments", F.lit(level))).withColumn("onward", F.size("segments") > level + 1)
    labels = stage(labels_of(tree), "branch-labels")
    branches = labels.groupBy("host", "node", "label")
    branches = branches.agg(smoothed(F.sum("blocked"), F.sum("allowed"), F.first("share")).alias("own"))
    named = labels.select("host", "node", "child", "label").join(branches, ["host", "node", "label"])
    rows = tree.join(named, ["host", "node", "child"], "left")
    node = F.when(F.col("child").isNull(), F.col("node")).otherwise(F.concat("node", F.lit("/"), "label"))
    kept = [c for c in tree.columns if c not in ("node", "share", "child", "onward")]
    return stage(rows.select(*kept, node.alias("node"), F.coalesce("own", "share").alias("share")), "path-tree")


def shape() -> Column:
    return F.regexp_replace("path", "[0-9]+", DIGITS)


def templates(urls: DataFrame) -> DataFrame:
    """urls (host, path, label 'block', 'allow' or null) -> host, shape, template, share of blocked, smoothed."""
    blocked, allowed = (F.sum(F.when(F.col("label") == v, 1.0).otherwise(0.0)) for v in ("block", "allow"))
    shapes = urls.groupBy("host", shape().alias("shape"))
    shapes = shapes.agg(F.count("*").cast("double").alias("n"), blocked.alias("blocked"), allowed.alias("allowed"))
    segments = F.when(F.col("shape") == "", F.array().cast("array<string>")).otherwise(F.split(F.expr("substring(shape, 2)"), "/", LEVELS))
    shapes = stage(shapes.withColumn("segments", segments), "shapes")

    all_blocked, all_labelled = shapes.agg(F.sum("blocked"), F.sum(F.col("blocked") + F.col("allowed"))).first()
    prior = F.lit((all_blocked or 0.0) / all_labelled if all_labelled else 0.0)
    hosts = shapes.groupBy("host").agg(smoothed(F.sum("blocked"), F.sum("allowed"), prior).alias("share"))
    tree = stage(shapes.join(hosts, "host").withColumn("node", F.lit("")), "path-tree")
    for level in range(LEVELS):
        tree = grown(tree, level)
    return tree.select("host", "shape", F.col("node").alias("template"), "share")


def judged(pages: DataFrame, rules: Sequence[Rule], labelled: Column | None = None) -> DataFrame:
    """pages (page_id, url) -> page_id, host, path, rule, verdict, template, share.

    Only urls where ``labelled`` (of page_id, host, path) holds teach; all that a rule fits, by default.
    """
    prepare(pages.sparkSession)
    rows = with_parts(pages)
    label = fitting(rules, "verdict")
    teaching = rows.withColumn("label", label if labelled is None else F.when(labelled, label))
    found = templates(teaching.select("host", "path", "label"))
    rows = rows.withColumn("shape", shape()).join(found, ["host", "shape"])
    learnt = F.when(F.col("share") >= REJECT, "block").otherwise("allow")
    return rows.select(
        "page_id", "host", "path", fitting(rules, "name").alias("rule"), F.coalesce(label, learnt).alias("verdict"), "template", "share"
    )
