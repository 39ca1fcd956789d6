"""Toxicity score of texts: a linear classifier over character n-grams.

Features are the n-grams of 3 to 5 characters that occur in a text, hashed into 2 ** 18 buckets. A
bucket's naive Bayes log-count ratio r is the log of its smoothed share among toxic over that among
other texts; a present feature has the value r. A logistic regression over the most telling
buckets gives the weights, and the score is its probability.

The classifier is fitted on at most ``SAMPLE`` labelled rows, those with the smallest hash of their
id; all other steps read every row. What tasks share is bounded by the number of buckets.

Defined results: null is the empty text and has the score of no feature; letters are lower-cased,
white space of any kind is a space. Labels of a repeated id count as toxic if one does; null labels
and null ids teach nothing. Without labels of both kinds each score is the smoothed share of toxic
labels. Result columns replace columns of the same name. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from bayline.llm.common import packed, stage, unpacked

ORDERS = (3, 4, 5)
BITS = 18
SAMPLE = 20_000
FEATURES = 2048
SMOOTHING = 1.0
THRESHOLD = 0.7
#: Characters whose n-grams are made at once.
CHARS_AT_ONCE = 1 << 18
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Model:
    """A weight per bucket, already multiplied by the bucket's log-count ratio."""

    weights: np.ndarray
    intercept: float


def codes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, one after the other, and the number of the text of each."""
    encoded = [" ".join(t.lower().split()).encode("utf-32-le", "surrogatepass") if t else b"" for t in texts]
    point = np.frombuffer(b"".join(encoded), "<u4")
    return point, np.repeat(np.arange(len(texts)), [len(e) // 4 for e in encoded])


def buckets(point: np.ndarray, text: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text, bucket) of each n-gram, order by order."""
    mixed = (point.astype(np.uint64) + np.uint64(1)) * MULTIPLIER
    mixed ^= mixed >> np.uint64(31)
    rolled = mixed
    for n in range(2, max(ORDERS) + 1):
        rolled = rolled[:-1] * MULTIPLIER + mixed[n - 1 :]
        if n in ORDERS and len(rolled):
            same = text[: len(rolled)] == text[n - 1 :]
            bucket = ((rolled ^ (rolled >> np.uint64(29))) * MULTIPLIER) >> np.uint64(64 - BITS)
            yield text[: len(rolled)][same], bucket[same].astype(np.int64)


def groups(texts: list[str | None]) -> Iterator[tuple[int, list[str | None]]]:
    """Runs of texts of about CHARS_AT_ONCE characters, with the number of the first."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= CHARS_AT_ONCE:
            yield start, texts[start : i + 1]
            start, size = i + 1, 0
    if start < len(texts):
        yield start, texts[start:]


def present(texts: list[str | None], chosen: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Distinct (text, bucket) pairs, of the chosen buckets only if given."""
    for first, group in groups(texts):
        found = []
        for text, bucket in buckets(*codes(group)):
            if chosen is not None:
                keep = chosen[bucket]
                text, bucket = text[keep], bucket[keep]
            found.append(text << BITS | bucket)
        pairs = np.unique(np.concatenate(found)) if found else np.empty(0, np.int64)
        yield first, (pairs >> BITS) + first, pairs & ((1 << BITS) - 1)


def count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow: labelled texts -> (bucket, toxic, other) document counts of the partition."""
    totals = np.zeros((2, 1 << BITS), np.int64)
    for batch in batches:
        toxic = np.array(batch.column("toxic").to_pylist(), np.int64)
        for _, text, bucket in present(batch.column("text").to_pylist()):
            for label in (0, 1):
                totals[label] += np.bincount(bucket[toxic[text] == label], minlength=1 << BITS)
    some = np.flatnonzero(totals.sum(0))
    columns = [pa.array(some), pa.array(totals[1][some]), pa.array(totals[0][some])]
    yield pa.RecordBatch.from_arrays(columns, names=["bucket", "toxic", "other"])


def feature_rows(slot: np.ndarray, ratio: np.ndarray):
    """For mapInArrow: labelled texts -> slots and values of their chosen features."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("label", pa.float64()), ("slots", pa.list_(pa.int32())), ("values", pa.list_(pa.float64()))])
        for batch in batches:
            n = batch.num_rows
            texts, where = batch.column("text").to_pylist(), [(np.empty(0, np.int64),) * 2]
            for _, text, bucket in present(texts, slot >= 0):
                where.append((text, bucket))
            text, bucket = (np.concatenate(c) for c in zip(*where))
            order = np.lexsort((slot[bucket], text))
            text, bucket = text[order], bucket[order]
            ends = np.searchsorted(text, np.arange(n + 1))
            offsets = pa.array(ends, pa.int32())
            slots = pa.ListArray.from_arrays(offsets, pa.array(slot[bucket], pa.int32()))
            values = pa.ListArray.from_arrays(offsets, pa.array(ratio[bucket], pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("toxic").cast(pa.float64()), slots, values], schema=schema)

    return rows


def labelled_sample(docs: DataFrame, labels: DataFrame, learn: Column, sample: int) -> DataFrame:
    """text and toxic of at most ``sample`` labelled rows."""
    one = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    one = one.groupBy("doc_id").agg(F.max((F.col("toxic") == 1).cast("int")).alias("toxic")).filter(learn)
    order = F.xxhash64(F.col("doc_id").cast("string"))
    few = stage(one.orderBy(order, "doc_id").limit(sample), "labelled")
    return stage(docs.select("doc_id", "text").join(F.broadcast(few), "doc_id"), "labelled-texts")  # at most ``sample`` rows


def fit(docs: DataFrame, labels: DataFrame, learn: Column, sample: int = SAMPLE, features: int = FEATURES) -> Model:
    """Fit on rows of ``labels`` (doc_id, toxic) for which ``learn`` holds."""
    rows = labelled_sample(docs, labels, learn, sample)
    n, toxic = rows.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    empty = np.zeros(1 << BITS, np.float32)
    if not 0 < toxic < n:
        return Model(empty, math.log((toxic + 1) / (n - toxic + 1)))
    counts = rows.mapInArrow(count_rows, "bucket long, toxic long, other long").groupBy("bucket")
    counted = counts.agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other")).toPandas()  # a row per bucket
    there = np.zeros((2, 1 << BITS))
    there[:, counted["bucket"]] = counted["toxic"], counted["other"]
    shares = (there + SMOOTHING) / (np.array([[toxic], [n - toxic]]) + 2 * SMOOTHING)
    ratio = np.log(shares[0] / shares[1])
    both = there.sum(0) / n
    error = np.sqrt(np.maximum(both * (1 - both), 1e-9) * (1 / toxic + 1 / (n - toxic)))
    strength = np.abs(there[0] / toxic - there[1] / (n - toxic)) / error
    best = np.lexsort((np.arange(1 << BITS), -strength))[:features]
    slot = np.full(1 << BITS, -1, np.int32)
    slot[best] = np.arange(len(best))
    as_vector = F.udf(lambda slots, values: Vectors.sparse(features, slots, values), VectorUDT())
    made = rows.mapInArrow(feature_rows(slot, ratio), "label double, slots array<int>, values array<double>")
    training = stage(made, "features").select("label", as_vector("slots", "values").alias("features")).cache()
    try:
        fitted = LogisticRegression(maxIter=60, regParam=0.002, standardization=False).fit(training)
    finally:
        training.unpersist()
    weights = empty.copy()
    weights[best] = (fitted.coefficients.toArray() * ratio[best]).astype(np.float32)
    return Model(weights, float(fitted.intercept))


def text_scores(texts: list[str | None], model: Model) -> np.ndarray:
    total = np.full(len(texts), model.intercept)
    chosen = model.weights != 0
    for _, text, bucket in present(texts, chosen):
        total += np.bincount(text, model.weights[bucket], len(texts))
    return 1 / (1 + np.exp(-np.clip(total, -500, 500)))


def scored(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Each row with its score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2 ** 18 weights

    @F.pandas_udf(DoubleType())
    def score(texts):
        import pandas as pd

        return pd.Series(text_scores(texts.tolist(), shared.value))

    return unpacked(packed(docs, score=score(F.col(text))), "score")
