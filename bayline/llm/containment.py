"""Test items inside long documents: MinHash containment search by size class, checked exactly.

Sets are the distinct five-word shingles of a text (letters and digits, lower-cased). An item
counts as contained if at least 0.8 of its shingles are in the document. An item of one to four words is one
shingle of that width, so it is contained wherever its words follow each other.

Items are partitioned by size. An item of s shingles, of which n must be found, publishes its
s - n + 1 smallest hashes: a document that holds n of the s shingles holds one of these, so no item
is missed, however long the document is. A size class has a bound, the largest hash that one of
its items publishes; documents publish only shingles up to the largest bound of the classes they are
large enough for. Of the widths below five that an item has, if any, documents publish every shingle. Pairs that
share a published hash are candidates, and the shingles of candidate documents are then compared as strings.

Only DataFrame functions are used. No side is broadcast but by Spark's own choice by size.

Defined results: null and blank texts have no shingle and match nothing. Rows that share an id are taken one by one, and a pair of
ids has its best containment. Extra columns are ignored. Empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bayline.llm.common import stage

WIDTH = 5
SHARE = "0.8"
BREAKS = r"[^\p{L}\p{N}]+"


def with_words(df: DataFrame, text: str = "text") -> DataFrame:
    words = F.array_remove(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), BREAKS), "")
    return df.withColumn("_words", words)


def shingle_hashes(width: int) -> Column:
    """Hashes of the shingles of ``_words`` by way of ``_hashed``, the hash of each word."""
    first = F.sequence(F.lit(1), F.size("_words") - width + 1)
    each = F.transform(first, lambda i: F.xxhash64(*[F.element_at("_hashed", i + j) for j in range(width)]))
    return F.when(F.size("_words") >= width, each).otherwise(F.array().cast("array<long>"))


def shingle_strings(width: int) -> Column:
    first = F.sequence(F.lit(1), F.size("_words") - width + 1)
    each = F.transform(first, lambda i: F.concat_ws(" ", F.slice("_words", i, width)))
    return F.when(F.size("_words") >= width, each).otherwise(F.array().cast("array<string>"))


def of_own_width(shingles, width: int) -> Column:
    """The shingles of an item: of ``width``, or of its own number of words if it has fewer."""
    found = shingles(width)
    for short in range(1, width):
        found = F.when(F.size("_words") == short, shingles(short)).otherwise(found)
    return found


def with_hashes(df: DataFrame) -> DataFrame:
    return df.withColumn("_hashed", F.transform("_words", lambda w: F.xxhash64(w)))


def item_sets(items: DataFrame, width: int, share: str) -> DataFrame:
    """item_id, item (key of the row), n, need, minima (ascending)."""
    # filtered by words: a filter on the shingles would make them anew below the projections
    rows = with_hashes(with_words(items.select("item_id", "text")).filter(F.size("_words") > 0))
    rows = rows.withColumn("_set", F.array_sort(F.array_distinct(of_own_width(shingle_hashes, width))))
    need = F.expr(f"CAST(ceil(size(_set) * CAST({share} AS DECIMAL(9, 6))) AS INT)")
    rows = rows.withColumn("n", F.size("_set")).withColumn("need", need)
    minima = F.slice("_set", F.lit(1), F.col("n") - F.col("need") + 1)
    return rows.select("item_id", F.xxhash64("item_id", "text").alias("item"), "n", "need", minima.alias("minima"), "_words")


def published_bound(items: DataFrame) -> Column:
    """The largest hash that a document of ``size(_shingles)`` shingles has to publish."""
    size_class = F.floor(F.log2("n")).alias("size_class")
    classes = items.groupBy(size_class).agg(
        F.min("need").alias("need"), F.max(F.element_at("minima", -1)).alias("bound")
    )
    bound, highest = F.lit(None).cast("long"), None
    for need, value in sorted((r.need, r.bound) for r in classes.collect()):  # one row per power of two
        highest = value if highest is None else max(highest, value)
        bound = F.when(F.size("_shingles") >= need, F.lit(highest)).otherwise(bound)
    return bound


def contained(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, share: str = SHARE
) -> DataFrame:
    """doc_id, row (hash of id and text), item_id, n_shingles, n_found for each contained item."""
    sets = stage(item_sets(items, width, share), "item-sets")
    short = sorted(r[0] for r in sets.filter(F.size("_words") < width).select(F.size("_words")).distinct().collect())  # fewer than ``width`` numbers
    minima = stage(sets.select("item", F.explode("minima").alias("hash")).select("hash").distinct(), "item-minima")
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    rows = rows.withColumn("row", F.xxhash64(F.col("doc_id"), F.col("text")))
    published = with_hashes(with_words(rows).select("row", "_words"))
    published = published.select("row", shingle_hashes(width).alias("_shingles"), *[shingle_hashes(w).alias(f"_short_{w}") for w in short])
    published = published.withColumn("_bound", published_bound(sets.filter(F.size("_words") >= width)))
    few = F.coalesce(F.filter("_shingles", lambda h: h <= F.col("_bound")), F.array().cast("array<long>"))
    published = published.select("row", F.explode(F.array_distinct(F.concat(few, *[f"_short_{w}" for w in short]))).alias("hash"))
    candidates = stage(published.join(minima, "hash").select("row").distinct(), "candidate-documents")

    shingles = sets.select("item_id", "item", "n", "need", F.explode(F.array_distinct(of_own_width(shingle_strings, width))).alias("shingle"))
    shingles = stage(shingles.withColumn("hash", F.xxhash64("shingle")), "item-shingles")
    known = stage(shingles.select("hash").distinct(), "item-hashes")
    suspects = with_words(rows.join(candidates, "row", "left_semi")).select("doc_id", "row", "_words")
    strings = F.concat(*[shingle_strings(w) for w in [width, *short]])
    suspects = suspects.select("doc_id", "row", F.explode(F.array_distinct(strings)).alias("shingle"))
    suspects = suspects.withColumn("hash", F.xxhash64("shingle")).join(known, "hash", "left_semi")
    shared = suspects.join(shingles, ["hash", "shingle"])
    counted = shared.groupBy("doc_id", "row", "item_id", "item", "n", "need").agg(F.countDistinct("shingle").alias("n_found"))
    found = counted.filter("n_found >= need")
    return found.select("doc_id", "row", "item_id", F.col("n").alias("n_shingles"), "n_found")


def leaks(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """doc_id, item_id, containment: one row per pair of ids."""
    share = F.max(F.col("n_found") / F.col("n_shingles"))
    return contained(docs, items, **options).groupBy("doc_id", "item_id").agg(share.alias("containment"))


def decontaminated(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that contain no item."""
    bad = stage(contained(docs, items, key, text, **options).select(F.col("row").alias("_leaked_row")).distinct(), "leaked")
    return docs.join(bad, F.xxhash64(F.col(f"`{key}`"), F.col(f"`{text}`")) == F.col("_leaked_row"), "left_anti")
