"""Trie of the prefixes of conversations that are rebuilt from a base's head and their own suffix.

A turn is known by a reference, the SHA-256 of its role and text, and by its length; texts are read once and
never moved. A sequence of turns has a fingerprint, a product in the monoid of ``products``: two lanes of
hash sums and the sum of lengths. That of a rebuilt prefix is put together from the products of the base's
head and of the conversation's own rows, without its text: head * own(h)^-1 * own(d).

Members with equal depth and fingerprint are a node. A group is verified: all its members must have the same
reference as their last turn and the same fingerprint as their parent, so equal sequences follow from depth
to depth. If a group fails, other bases are taken and everything is fingerprinted anew.

Sums over subtrees need no walk. A node belongs to its smallest member; the nodes of a member c form the end
of its path, below a part of its path that belongs to smaller members and has w(c) code points (all of them,
if c has no node of its own). With the code points z before a node's last turn,
saved(node) = sum of w over its members - w(smallest) - (n - 1) * z, and the leaves of a subtree are those
whose smallest member is a member of the node. Both are sums per node, combined before the shuffle.

The ids that end at a node are joined to strings of at most ``IDS`` ids over ranges, so the task that digests
them in order reads few rows.

Defined results: turns are taken by turn, nulls first, rows of equal turn by reference. A null role or text is
empty. Rows with a null ``conv_id`` are of no conversation. Other columns are not read. An empty table has no
nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bayline.llm.common import prepare, shuffle_partitions, stage
from bayline.llm.products import P, as_words, folded, minus, powers, prefix_products, signed, times

#: Conversations of one base, and the modulus that chooses how many of its turns a conversation takes.
BLOCK, HEADS = 100, 6
IDS = 4096
KEY = ["depth", "f1", "f2"]
LANES = ("v1", "v2", "size")


def bases(salt: int) -> tuple[int, int]:
    """Two bases of the hash sums, other ones for each salt."""
    digest = hashlib.sha256(b"bases %d" % salt).digest()
    return tuple(int.from_bytes(digest[i : i + 8], "little") % (P - 2) + 2 for i in (0, 8))


def turn_references(turns: DataFrame) -> DataFrame:
    """conv_id, turn, ref (SHA-256 of role and text), its two hash values, size in code points."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    rows = turns.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.sha2(whole, 256).alias("hex"),
        F.char_length(text).cast("long").alias("size"),
    )
    values = [F.conv(F.substring("hex", at, 15), 16, 10).cast("long").alias(f"v{i}") for i, at in ((1, 1), (2, 16))]
    return rows.select("conv_id", "turn", F.unhex("hex").alias("ref"), *values, "size")


def head_length() -> Column:
    return (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).cast("long")


def constants(turns: DataFrame) -> DataFrame:
    """A row for each conversation: h, head (the base's first turns that it takes), k (how many), what the
    head's and the own first h turns amount to, and the length of the rebuilt conversation."""
    sides = [f"{lane}_{side}" for lane in LANES for side in ("before", "through")]
    own = F.max(F.when(F.col("place") == F.col("h") - 1, F.struct(*[F.col(f"{lane}_through").alias(lane) for lane in LANES])))
    each = turns.withColumn("h", head_length()).groupBy("conv_id", "h").agg(F.count("*").alias("n"), own.alias("own"))
    heads = turns.filter((F.col("conv_id") % BLOCK == 0) & (F.col("place") < HEADS - 1))
    heads = heads.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("place", "ref", "size", *sides))).alias("first"))  # few turns
    heads = heads.withColumnRenamed("conv_id", "base")
    rows = each.withColumn("base", F.col("conv_id") - F.col("conv_id") % BLOCK).join(heads, "base", "left")
    rows = rows.withColumn("k", F.least("h", F.coalesce(F.size("first"), F.lit(0))))
    rows = rows.withColumn("head", F.when(F.col("k") > 0, F.slice("first", 1, F.col("k").cast("int"))))
    end = F.get("head", (F.col("k") - 1).cast("int"))
    zero = F.lit(0).cast("long")
    return rows.select(
        "conv_id", "h", "k", "head",
        (F.col("k") + F.greatest(F.col("n") - F.col("h"), zero)).alias("total"),
        *[F.coalesce(end[f"{lane}_through"], zero).alias(f"{lane}_head") for lane in LANES],
        *[F.coalesce(F.col("own")[lane], zero).alias(f"{lane}_own") for lane in LANES],
    )


def composed(base: tuple[int, int]):
    """For mapInArrow: own rows behind the head -> products of the rebuilt prefix: head * own(h)^-1 * own(d)."""
    names = {("v1", "through"): "f1", ("v2", "through"): "f2", ("v1", "before"): "p1", ("v2", "before"): "p2", ("size", "before"): "z"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shift = batch.column("k").to_numpy() - batch.column("h").to_numpy()
            out = {c: batch.column(c) for c in ("conv_id", "depth", "ref", "size", "ends")}
            for (lane, side), name in names.items():
                own = minus(as_words(batch.column(f"{lane}_{side}")), as_words(batch.column(f"{lane}_own")))
                if lane != "size":
                    own = times(own, powers(base[lane == "v2"], shift))
                out[name] = signed(folded(own + as_words(batch.column(f"{lane}_head"))))
            yield pa.RecordBatch.from_arrays([out[c] for c in MEMBER_NAMES], names=MEMBER_NAMES)

    return run


MEMBERS = (
    "conv_id long, depth long, f1 long, f2 long, p1 long, p2 long, z long, ref binary, size long, ends boolean"
)
MEMBER_NAMES = [c.split()[0] for c in MEMBERS.split(", ")]


def members(references: DataFrame, base: tuple[int, int]) -> DataFrame:
    """A row for each depth of each rebuilt conversation: fingerprint f, the parent's p, code points z before
    the last turn, reference and size of the last turn, whether the conversation ends."""
    lanes = [("v1", base[0]), ("v2", base[1]), ("size", 1)]
    turns = prefix_products(references, "conv_id", ["turn", "ref"], lanes, ["ref", "size"])
    convs = stage(constants(turns), "conversations")

    zero, null = F.lit(0).cast("long"), F.lit(None)
    roots = convs.select(
        "conv_id", zero.alias("depth"), zero.alias("f1"), zero.alias("f2"), null.cast("long").alias("p1"), null.cast("long").alias("p2"),
        zero.alias("z"), null.cast("binary").alias("ref"), zero.alias("size"), (F.col("total") == 0).alias("ends"),
    )
    heads = convs.select("conv_id", "total", F.explode("head").alias("t")).withColumn("depth", F.col("t.place") + 1)
    heads = heads.select(
        "conv_id", "depth", F.col("t.v1_through").alias("f1"), F.col("t.v2_through").alias("f2"), F.col("t.v1_before").alias("p1"),
        F.col("t.v2_before").alias("p2"), F.col("t.size_before").alias("z"), "t.ref", "t.size", (F.col("depth") == F.col("total")).alias("ends"),
    )
    own = turns.join(convs.drop("head"), "conv_id").filter("place >= h").withColumn("depth", F.expr("k + place - h + 1"))
    own = own.withColumn("ends", F.col("depth") == F.col("total")).mapInArrow(composed(base), MEMBERS)
    return roots.unionAll(heads).unionAll(own)


def verified_nodes(references: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members and nodes, fingerprinted until every group of members is of one sequence."""
    for salt in count():
        rows = stage(members(references, bases(salt)), "members")
        seen = F.struct("p1", "p2", "ref")
        nodes = rows.groupBy(*KEY).agg(
            F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.min(seen).alias("seen"), F.max(seen).alias("other"), F.min("size").alias("size"), F.min("z").alias("z")
        )
        nodes = stage(nodes, "nodes")
        if nodes.filter("NOT seen <=> other").isEmpty():
            return rows, nodes.select(*KEY, "n_convs", "conv_id", "seen.p1", "seen.p2", "z")


def joined_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow: (node, conv_id) in order -> strings of ids of one node, in order."""
    for batch in batches:
        node = [batch.column(c).to_numpy() for c in KEY]
        ids = batch.column("conv_id").to_numpy()
        new = np.append(True, np.logical_or.reduce([c[1:] != c[:-1] for c in node]))
        starts = np.flatnonzero(new).tolist()
        text = [",".join(map(str, ids[i:j].tolist())) for i, j in zip(starts, [*starts[1:], len(ids)])]
        arrays = [pa.array(c[starts]) for c in [*node, ids]] + [pa.array(text)]
        yield pa.RecordBatch.from_arrays(arrays, names=[*KEY, "first", "ids"])


def ids_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow: strings of ids in order -> SHA-256 of each node's."""
    now, state, names = None, None, [*KEY, "ends_sha256"]
    for batch in batches:
        done = []
        for *node, ids in zip(*(batch.column(c).to_pylist() for c in [*KEY, "ids"])):
            if node != now:
                if state is not None:
                    done.append((*now, state.hexdigest()))
                now, state = node, hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=names)
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([c]) for c in (*now, state.hexdigest())], names=names)


def end_digests(rows: DataFrame) -> DataFrame:
    """SHA-256 of the ids, in order, of the members that end at a node."""
    n = shuffle_partitions(rows.sparkSession)
    ends = rows.filter("ends").select(*KEY, "conv_id")
    pieces = ends.repartitionByRange(n, *KEY, "conv_id").sortWithinPartitions(*KEY, "conv_id")
    key = ", ".join(f"{c} long" for c in KEY)
    pieces = pieces.mapInArrow(joined_ids, f"{key}, first long, ids string")
    return pieces.repartition(n, *KEY).sortWithinPartitions(*KEY, "first").mapInArrow(ids_digests, f"{key}, ends_sha256 string")


def trie(turns: DataFrame) -> DataFrame:
    """turns (conv_id, turn, role, text) -> a row for each node."""
    prepare(turns.sparkSession)
    rows, nodes = verified_nodes(turn_references(turns))
    children = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("f1"), F.col("p2").alias("f2"))
    nodes = stage(nodes.join(children.agg(F.count("*").alias("n_children")), KEY, "left"), "nodes-with-children")

    tops = nodes.groupBy("conv_id").agg(F.min_by("z", "depth").alias("w"), F.max(F.col("n_children").isNull()).cast("long").alias("leaf"))
    whole = rows.filter("ends").select("conv_id", (F.col("z") + F.col("size")).alias("all"))
    each = whole.join(tops, "conv_id", "left")
    each = stage(each.select("conv_id", F.coalesce("w", "all").alias("w"), F.coalesce("leaf", F.lit(0)).alias("leaf")), "above")
    sums = rows.select("conv_id", *KEY).join(each, "conv_id").groupBy(*KEY)
    sums = sums.agg(F.sum("w").alias("w"), F.sum("leaf").alias("n_leaves"), F.min(F.struct("conv_id", "w")).alias("first"))

    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("f1").alias("p1"), F.col("f2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    found = nodes.join(sums, KEY).join(end_digests(rows), KEY, "left").join(parents, ["depth", "p1", "p2"], "left")
    return found.select(
        "conv_id", "depth", "parent_conv_id", "n_convs",
        F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        "n_leaves",
        (F.col("w") - F.col("first.w") - (F.col("n_convs") - 1) * F.col("z")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )
