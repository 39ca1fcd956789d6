"""The registered queries: each operator over its whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bayline.llm import containment, curriculum, hilbert, kneser_ney, repair, simhash, suffixes, templates, topk, toxicity, trie, warc, wavelet
from bayline.llm.common import given, shuffle_partitions
from bayline.llm.registry import ORACLES, QUERIES, query  # noqa: F401
from bayline.session import scratch_dir

OP10_SQL = r"""
WITH d AS (
  SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS k,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
r AS (
  SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS kind, 2.0 * source_size AS most FROM s),
w AS (
  SELECT *, CAST(CASE kind WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS DOUBLE) AS weight FROM r),
f AS (
  SELECT *, coalesce(sum(most) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS full_before,
    sum(weight) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free,
    CAST(1.5 AS DOUBLE) * sum(source_size) OVER () AS total
  FROM w),
l AS (
  SELECT arg_min((total - full_before) / free, most / weight) FILTER (WHERE most >= (total - full_before) / free * weight) AS level FROM f),
t AS (
  SELECT source, source_size, kind, least(level * weight, CAST(most AS DOUBLE)) AS target FROM w, l),
c AS (
  SELECT d.*, t.source_size, t.target,
    coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY k, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
p AS (
  SELECT *, coalesce(floor(target / nullif(source_size, 0)), 0) AS whole FROM c)
SELECT doc_id, size, source_size, round(target, 6) AS target,
  CAST(whole + CASE WHEN target - whole * source_size > 0 AND before + size / 2.0 <= target - whole * source_size THEN 1 ELSE 0 END AS INT) AS copies,
  CAST(size * (whole + CASE WHEN target - whole * source_size > 0 AND before + size / 2.0 <= target - whole * source_size THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM p
"""


@query("op10_curriculum_mix", OP10_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes from every document, in the order of the first copy's position."""
    docs = given(spark, sf_dir, "documents").select("doc_id", "text", "source")
    slim = docs.select("doc_id", "source", curriculum.word_count("text").alias("words"))
    rows = curriculum.allocate(slim, F.col("words"))
    order = [F.get("positions", F.lit(0)).asc_nulls_last(), F.col("doc_id")]
    rows = rows.repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order)
    return rows.select(
        "doc_id", "size", "source_size", F.round("target", 6).alias("target"), "copies", "taken"
    )


@query("op5_hilbert_shards")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards along a Hilbert curve over source, language and length."""
    docs = given(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    rows = hilbert.shards(docs, 24, ["source", "lang", "n_chars"])
    return rows.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 8).alias("size"),
        F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "curve",
    )


OP8_SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (
  SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY 1)
SELECT page_id, payload_bytes, p.payload_digest,
  CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""


@query("op8_warc_archives", OP8_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as WARC archives and read back from them."""
    pages = given(spark, sf_dir, "pages").select("page_id", "url", "html")
    manifest, path = warc.scratch_archives(pages)
    rows = warc.read_archives(manifest, path)
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op6_simhash_groups")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprint and near-duplicate component of every document."""
    docs = given(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.grouped(docs, keep=["doc_id"]).select("doc_id", "fingerprint", "component_id")


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_wavelet_tokens")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents, written to wavelet-matrix files and read back from them."""
    docs = given(spark, sf_dir, "documents").select("doc_id", "text")
    path = scratch_dir(spark, "tokens")
    manifest = wavelet.write_tokens(docs, path, tokenizer_file("word_bpe_49k.json"))
    return wavelet.read_tokens(manifest, path).select("doc_id", "start", "n_tokens", "ids_crc32")


def remainder(modulus: int) -> Column:
    """crc32 of the document's id as text, modulo; null for a null id."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus


@query("op2_toxicity_scores")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document by the n-gram classifier."""
    docs = given(spark, sf_dir, "documents").select("doc_id", "text")
    labels = given(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = toxicity.fit(docs, labels, remainder(3) != 1)
    rows = toxicity.scored(docs, model)
    held_out = F.coalesce(remainder(3) == 1, F.lit(False)).alias("held_out")
    predicted = (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted")
    return rows.select("doc_id", held_out, "score", predicted)


OP3_SQL = r"""
WITH dw AS (
  SELECT doc_id, [x FOR x IN regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+') IF x <> ''] AS w FROM documents WHERE text IS NOT NULL),
iw AS (
  SELECT item_id, [x FOR x IN regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+') IF x <> ''] AS w FROM benchmark WHERE text IS NOT NULL),
widths AS (
  SELECT DISTINCT least(len(w), 5) AS k FROM iw WHERE len(w) > 0),
ds AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + k - 1], ' ') AS s
  FROM (SELECT doc_id, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i FROM dw JOIN widths ON len(w) >= k)),
its AS (
  SELECT DISTINCT item_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(1, len(w) - 4))) AS i FROM iw WHERE len(w) > 0)),
n AS (SELECT item_id, count(*) AS n FROM its GROUP BY 1)
SELECT doc_id, item_id, CAST(count(*) AS DOUBLE) / any_value(n) AS containment
FROM ds JOIN its USING (s) JOIN n USING (item_id)
GROUP BY doc_id, item_id HAVING count(*) >= ceil(any_value(n) * 0.8)
"""


@query("op3_benchmark_leaks", OP3_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item."""
    docs = given(spark, sf_dir, "documents").select("doc_id", "text")
    return containment.leaks(docs, given(spark, sf_dir, "benchmark"))


OP9_SQL = """
WITH v AS (
  SELECT vec_id, [floor(1024 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id, score
FROM s QUALIFY rank <= 10
"""


@query("op9_bit_sliced_top_k", OP9_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best vectors for each vector whose id is divisible by 100."""
    vectors = given(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk.top_k(vectors, vectors.filter("vec_id % 100 = 0"))


@query("op4_kneser_ney_scores")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every document under the trigram model and under the base."""
    docs = given(spark, sf_dir, "documents").select("doc_id", "text")
    model = kneser_ney.train(docs.filter(F.coalesce(remainder(7) != 2, F.lit(True))), order=3)
    rows = kneser_ney.scored(docs, model)
    held_out = F.coalesce(remainder(7) == 2, F.lit(False)).alias("held_out")
    total = F.lit(model.counts.tokens).cast("long").alias("train_tokens")
    perplexity = F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity")
    return rows.select("doc_id", held_out, "n_tokens", "n_known", total, "base_score", "score", perplexity)


@query("op7_repeated_strings")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the bytes of repeated strings of 200 bytes."""
    docs = given(spark, sf_dir, "documents").select("doc_id", "text")
    rows = suffixes.without_repeats(docs)
    spans = F.size("spans").cast("long").alias("n_spans")
    return rows.select("doc_id", "n_bytes", "n_removed", spans, "kept_sha256")



def crc32_sql(text: str) -> str:
    """SQL for crc32 of a short ASCII string: each byte enters, then eight shifts, written as -1."""
    steps = f"flatten([[ascii(substr({text}, i, 1)), -1, -1, -1, -1, -1, -1, -1, -1] FOR i IN range(1, len({text}) + 1)])"
    shift = "xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END)"
    return f"xor(list_reduce(list_prepend(4294967295, {steps}), lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE {shift} END), 4294967295)"


OP11_SQL = rf"""
WITH RECURSIVE given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
kinds AS (
  SELECT *, {crc32_sql("k")} % 20 AS kind FROM given),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM kinds WHERE kind <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen,
    regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS last
  FROM damaged),
faults AS (
  SELECT *, last = '' AS blank, last <> '' AND seen > 1 AS duplicate, last <> '' AND seen = 1 AND last NOT IN ('.', '!', '?') AS truncated,
    left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS former
  FROM placed),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
    count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated,
    count(*) FILTER (former || initial NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n
  FROM faults GROUP BY conv_id),
rows AS (
  SELECT conv_id, i, role, text, CASE WHEN truncated THEN 5 ELSE 0 END + CASE WHEN blank OR duplicate THEN 1000000 ELSE 0 END AS t,
    CASE WHEN initial = 's' THEN 0 ELSE 1000000 END AS s, CASE WHEN initial = 'u' THEN 0 ELSE 1000000 END AS u,
    CASE WHEN initial = 'a' THEN 0 ELSE 1000000 END AS a
  FROM faults),
least_rest AS (
  SELECT conv_id, n + 1 AS i, 0 AS v0, 10 AS v1, 5 AS v2, 0 AS v3 FROM counts
  UNION ALL
  SELECT conv_id, i, least(e0, e2 + 5, e3 + 10), least(e1, e2 + 5, e3 + 10), least(e2, e3 + 5), least(e3, e2 + 5)
  FROM (
    SELECT r.conv_id, r.i, least(2 + v0, t + s + v1, t + least(u, 1) + v2) AS e0, least(2 + v1, t + least(u, 1) + v2) AS e1,
      least(2 + v2, t + least(a, 1) + v3) AS e2, least(2 + v3, t + least(u, 1) + v2) AS e3
    FROM least_rest l JOIN rows r ON r.conv_id IS NOT DISTINCT FROM l.conv_id AND r.i = l.i - 1)),
rest AS (
  SELECT conv_id, i, [v0, v1, v2, v3] AS v, [v2, v2, v3, v2] AS onward FROM least_rest),
options AS (
  SELECT b.conv_id, b.i, r.role, r.text, t, s, u, a, b.v AS now, b.onward, n.v AS next
  FROM rest b LEFT JOIN rows r ON r.conv_id IS NOT DISTINCT FROM b.conv_id AND r.i = b.i
  LEFT JOIN rest n ON n.conv_id IS NOT DISTINCT FROM b.conv_id AND n.i = b.i + 1),
walk AS (
  SELECT conv_id, CAST(1 AS BIGINT) AS i, 1 AS state, '' AS audit, CAST([] AS VARCHAR[]) AS lines FROM counts
  UNION ALL
  SELECT conv_id, CASE WHEN edit = 'I' THEN i ELSE i + 1 END,
    CASE WHEN edit = 'D' THEN state WHEN edit = 'K' AND state = 1 AND s = 0 THEN 2 WHEN state = 3 THEN 4 ELSE 3 END,
    audit || edit,
    CASE edit WHEN 'D' THEN lines WHEN 'K' THEN list_append(lines, role || ':' || text)
      WHEN 'R' THEN list_append(lines, CASE WHEN state = 3 THEN 'assistant:' ELSE 'user:' END || text)
      ELSE list_append(lines, CASE WHEN state = 3 THEN 'assistant:' ELSE 'user:' END) END
  FROM (
    SELECT w.*, o.role, o.text, o.s,
      CASE WHEN o.next[w.state] + 2 = o.now[w.state] THEN 'D'
        WHEN o.onward[w.state] + 5 = o.now[w.state] THEN 'I'
        WHEN w.state = 1 AND o.t + o.s + o.next[2] = o.now[1] THEN 'K'
        WHEN w.state = 3 AND o.t + o.a + o.next[4] = o.now[3] THEN 'K'
        WHEN w.state <> 3 AND o.t + o.u + o.next[3] = o.now[w.state] THEN 'K'
        WHEN o.next IS NOT NULL THEN 'R' END AS edit
    FROM walk w JOIN options o ON o.conv_id IS NOT DISTINCT FROM w.conv_id AND o.i = w.i)
  WHERE edit IS NOT NULL),
ended AS (
  SELECT w.conv_id, r.v[1] AS cost, audit, sha256(array_to_string(lines, chr(10))) AS repaired_sha256
  FROM walk w JOIN counts c ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND w.i = c.n + 1 AND w.state IN (1, 4)
  JOIN rest r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.i = 1)
SELECT g.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost,
  coalesce(audit, '') AS audit, coalesce(repaired_sha256, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) g
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM g.conv_id
LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM g.conv_id
"""

@query("op11_repaired_conversations", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every damaged conversation."""
    turns = given(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return repair.summary(turns.select("conv_id"), repair.Repair(repair.damaged(turns)))


OP12_SQL = f"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, CAST(conv_id AS VARCHAR) AS k,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS place
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base, n, {crc32_sql("k")} % 6 AS h
  FROM (SELECT conv_id, k, count(*) AS n FROM t GROUP BY ALL)),
rebuilt AS (
  SELECT c.conv_id, place + 1 AS depth, role, text FROM c JOIN t ON t.conv_id = base AND place < h
  UNION ALL
  SELECT c.conv_id, least(c.h, coalesce(b.n, 0)) + place - c.h + 1, role, text
  FROM c JOIN t ON t.conv_id = c.conv_id AND place >= c.h LEFT JOIN c b ON b.conv_id = c.base),
lengths AS (
  SELECT c.conv_id, coalesce(max(depth), 0) AS total FROM c LEFT JOIN rebuilt USING (conv_id) GROUP BY ALL),
members AS (
  SELECT conv_id, depth, list({{'role': role, 'text': text}}) OVER (PARTITION BY conv_id ORDER BY depth) AS path, length(text) AS size
  FROM rebuilt
  UNION ALL
  SELECT conv_id, 0, [], 0 FROM c),
nodes AS (
  SELECT depth, path, min(m.conv_id) AS conv_id, count(*) AS n_convs, any_value(size) AS size,
    sha256(coalesce(string_agg(CAST(m.conv_id AS VARCHAR), ',' ORDER BY m.conv_id) FILTER (total = depth), '')) AS ends_sha256
  FROM members m JOIN lengths USING (conv_id) GROUP BY depth, path),
linked AS (
  SELECT n.*, p.conv_id AS parent_conv_id, count(ch.depth) AS n_children
  FROM nodes n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.path = n.path[:n.depth - 1]
  LEFT JOIN nodes ch ON ch.depth = n.depth + 1 AND ch.path[:n.depth] = n.path
  GROUP BY ALL),
sums AS (
  SELECT a.depth, a.path, sum(CAST(n_children = 0 AS BIGINT)) AS n_leaves, sum((n_convs - 1) * x.size) AS saved_tokens
  FROM linked x JOIN members a ON a.conv_id = x.conv_id AND a.depth <= x.depth GROUP BY ALL)
SELECT conv_id, depth, parent_conv_id, n_convs, n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
  CAST(saved_tokens AS BIGINT) AS saved_tokens, ends_sha256
FROM linked JOIN sums USING (depth, path)
"""


@query("op12_conversation_trie", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prefix trie of the rebuilt conversations."""
    return trie.trie(given(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))


RULES = [
    templates.Rule("allow", "org", "/"),
    templates.Rule("block", "example.org", "/es/"),
    templates.Rule("block", "example.org", "/en/1"),
    templates.Rule("allow", "com", "/fr/"),
    templates.Rule("block", "com", "/de/"),
]


def chi_sql(a: str, b: str, c: str, d: str) -> str:
    margins = f"({a} + {b}) * ({c} + {d}) * ({a} + {c}) * ({b} + {d})"
    return f"CASE WHEN {margins} > 0 THEN ({a} + {b} + {c} + {d}) * ({a} * {d} - {b} * {c}) * ({a} * {d} - {b} * {c}) / ({margins}) ELSE 0 END"


def op13_sql() -> str:
    fits = [f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')" for r in sorted(RULES, key=lambda r: -len(r.name))]
    named = sorted(RULES, key=lambda r: -len(r.name))
    rule, verdict = (" ".join(f"{w} THEN '{value}'" for w, value in zip(fits, values)) for values in ([r.name for r in named], [r.verdict for r in named]))
    others = [f"(w.{c} - e.{c})" for c in ("n", "b", "a", "o")]
    differs = chi_sql("e.b", "e.a", others[1], others[2]) + " + " + chi_sql("e.o", "(e.n - e.o)", others[3], f"({others[0]} - {others[3]})")
    levels = "".join(
        f"""
c{i} AS (
  SELECT *, segments[{i + 1}] AS child, CASE WHEN len(segments) > {i + 1} THEN n ELSE 0 END AS o FROM t{i}),
e{i} AS (
  SELECT host, node, child, sum(n) AS n, sum(b) AS b, sum(a) AS a, sum(o) AS o, any_value(share) AS share
  FROM c{i} WHERE child IS NOT NULL GROUP BY ALL),
w{i} AS (
  SELECT host, node, sum(n) AS n, sum(b) AS b, sum(a) AS a, sum(o) AS o FROM e{i} GROUP BY ALL),
l{i} AS (
  SELECT e.*, CASE WHEN w.n = e.n OR (e.n >= {templates.LEAST} AND e.n >= {templates.SHARE} * w.n AND {differs} > {templates.DIFFERENT})
    THEN child ELSE '*' END AS label
  FROM e{i} e JOIN w{i} w USING (host, node)),
s{i} AS (
  SELECT host, node, label, (sum(b) + {templates.STRENGTH} * any_value(share)) / (sum(b) + sum(a) + {templates.STRENGTH}) AS own FROM l{i} GROUP BY ALL),
t{i + 1} AS (
  SELECT c.host, c.shape, c.segments, c.n, c.b, c.a, CASE WHEN c.child IS NULL THEN c.node ELSE c.node || '/' || l.label END AS node,
    coalesce(s.own, c.share) AS share
  FROM c{i} c LEFT JOIN l{i} l ON l.host = c.host AND l.node = c.node AND l.child = c.child
  LEFT JOIN s{i} s ON s.host = l.host AND s.node = l.node AND s.label = l.label),"""
        for i in range(templates.LEVELS)
    )
    return rf"""
WITH p AS (
  SELECT page_id, lower(regexp_extract(rest, '^[^/?#]*', 0)) AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages)),
r AS (
  SELECT *, CASE {rule} END AS rule, CASE {verdict} END AS label, regexp_replace(path, '[0-9]+', '{{n}}', 'g') AS shape FROM p),
g AS (
  SELECT host, shape, CAST(count(*) AS DOUBLE) AS n, CAST(count(*) FILTER (label = 'block') AS DOUBLE) AS b,
    CAST(count(*) FILTER (label = 'allow') AS DOUBLE) AS a, string_split(shape[2:], '/') AS q FROM r GROUP BY host, shape),
h AS (
  SELECT host, (sum(b) + {templates.STRENGTH} * (SELECT sum(b) / sum(a + b) FROM g)) / (sum(b) + sum(a) + {templates.STRENGTH}) AS share FROM g GROUP BY host),
t0 AS (
  SELECT host, shape, n, b, a, '' AS node, share, CASE WHEN shape = '' THEN CAST([] AS VARCHAR[]) WHEN len(q) > {templates.LEVELS}
    THEN list_append(q[:{templates.LEVELS - 1}], array_to_string(q[{templates.LEVELS}:], '/')) ELSE q END AS segments
  FROM g JOIN h USING (host)),{levels}
z AS (SELECT host, shape, node, share FROM t{templates.LEVELS})
SELECT page_id, host, path, rule, coalesce(label, CASE WHEN share >= {templates.REJECT} THEN 'block' ELSE 'allow' END) AS verdict,
  node AS template, round(share, 6) AS share
FROM r JOIN z USING (host, shape)
"""


@query("op13_url_templates", op13_sql())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on the url of every page."""
    rows = templates.judged(given(spark, sf_dir, "pages").select("page_id", "url"), RULES)
    return rows.withColumn("share", F.round("share", 6))
