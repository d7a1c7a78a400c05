"""Registered queries of the subpackage and their SQL oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.llm import alignment, bytebpe, forest, langid, lattice, mixing, multiindex, passages, quality, secrets, topk, trie, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), topk.integer_vector("embedding").alias("v")
    )
    return topk.search(rows, rows.filter("id % 20 = 0"), k=20)


QUERIES["op1_maxscore"] = op1_maxscore
ORACLES["op1_maxscore"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, d.vec_id, CAST(list_inner_product(q.e, d.e) AS BIGINT) AS score
  FROM v q JOIN v d ON q.vec_id % 20 = 0 AND d.vec_id <> q.vec_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM scored)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM ranked WHERE n <= 20
"""


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.classify(docs, table(spark, sf_dir, "labels"))
    return scored.select("doc_id", quality.held_out().alias("held_out"), "score", "predicted")


QUERIES["op2_quality"] = op2_quality


def op3_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES["op3_passages"] = op3_passages


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages"))


QUERIES["op4_language"] = op4_language


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bytebpe.round_trip(table(spark, sf_dir, "documents"))


QUERIES["op5_byte_bpe"] = op5_byte_bpe


def op6_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multiindex.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.93)


QUERIES["op6_multi_index"] = op6_multi_index
ORACLES["op6_multi_index"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach(vec_id, node) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT r.vec_id, l.y FROM reach r JOIN links l ON l.x = r.node),
least AS (SELECT vec_id, min(node) AS component_id FROM reach GROUP BY vec_id),
degree AS (SELECT x AS vec_id, count(*) AS n FROM links GROUP BY x)
SELECT e.vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN least USING (vec_id) LEFT JOIN degree USING (vec_id)
"""


def op7_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), n_words=4)


QUERIES["op7_forest"] = op7_forest
ORACLES["op7_forest"] = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s
  FROM w),
one AS (SELECT doc_id, len(s) AS n, unnest(s) AS s FROM sets),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common, any_value(a.n) AS nx, any_value(b.n) AS ny
  FROM one a JOIN one b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM pairs WHERE 100 * common >= 80 * (nx + ny - common)),
ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(doc_id, node) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, e.y FROM reach r JOIN ways e ON e.x = r.node),
least AS (SELECT doc_id, min(node) AS component_id FROM reach GROUP BY doc_id)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, component_id, s.doc_id = component_id AS kept
FROM sets s JOIN least USING (doc_id)
"""


def op8_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.score(table(spark, sf_dir, "documents"), group="lang")


QUERIES["op8_lattice"] = op8_lattice


def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken", "whole", "part")


QUERIES["op9_source_mix"] = op9_source_mix
# Sorted by cap per weight, the clamped sources come first: one is clamped while its share of what is
# left, with all before it clamped, passes its cap. All products are integers.
ORACLES["op9_source_mix"] = """
WITH sized AS (
  SELECT doc_id, source,
         CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
         substr(coalesce(md5('9:' || CAST(doc_id AS VARCHAR)), '000'), 1, 3) AS bucket
  FROM documents),
sizes AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighted AS (
  SELECT *, [5, 2, 1][1 + (row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3] AS weight
  FROM sizes),
ordered AS (
  SELECT *, sum(source_size) OVER () AS total,
         coalesce(sum(source_size) OVER (ORDER BY source_size * 10 // weight, source IS NULL, source
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS held,
         sum(weight) OVER (ORDER BY source_size * 10 // weight, source IS NULL, source
             ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open
  FROM weighted),
marked AS (SELECT *, (3 * total - 4 * held) * weight > 4 * source_size * open AS above FROM ordered),
level AS (
  SELECT max(3 * total) - 4 * coalesce(sum(source_size) FILTER (above), 0) AS num,
         2 * sum(weight) FILTER (NOT above) AS den FROM marked),
filled AS (
  SELECT source, source_size,
         CAST(CASE WHEN above THEN 2 * source_size ELSE weight * num END AS BIGINT) AS num,
         CAST(CASE WHEN above THEN 1 ELSE den END AS BIGINT) AS den
  FROM marked, level),
plan AS (
  SELECT source, source_size, CAST(num AS DOUBLE) / CAST(den AS DOUBLE) AS target,
         CASE WHEN source_size > 0 THEN num // (den * source_size) ELSE 0 END AS whole
  FROM filled),
rest AS (SELECT *, CAST(round(target) AS BIGINT) - whole * source_size AS rest FROM plan),
grains AS (
  SELECT source, bucket, sum(size) AS words,
         sum(sum(size)) OVER (PARTITION BY source ORDER BY bucket) - sum(size) AS before
  FROM sized GROUP BY source, bucket),
cut AS (
  SELECT r.source, max(g.bucket) AS at, arg_max(r.rest - g.before, g.bucket) AS left_words,
         arg_max(g.words, g.bucket) AS words
  FROM grains g JOIN rest r ON g.source IS NOT DISTINCT FROM r.source
  WHERE g.before <= r.rest AND g.before + g.words > r.rest GROUP BY r.source),
parts AS (
  SELECT d.doc_id, d.size, r.source_size, r.target, CAST(r.whole AS BIGINT) AS whole,
         CAST(CASE WHEN c.at IS NULL THEN 0 WHEN d.bucket < c.at THEN d.size
              WHEN d.bucket = c.at THEN d.size * c.left_words // c.words ELSE 0 END AS BIGINT) AS part
  FROM sized d JOIN rest r ON d.source IS NOT DISTINCT FROM r.source
  LEFT JOIN cut c ON d.source IS NOT DISTINCT FROM c.source)
SELECT doc_id, size, source_size, target, whole, part, CAST(whole * size + part AS BIGINT) AS taken FROM parts
"""


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(table(spark, sf_dir, "pages"))


QUERIES["op10_warc"] = op10_warc
# Base32 takes the 160 bits of the digest in groups of five; 40 hex digits are 8 groups of 20 bits.
ORACLES["op10_warc"] = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS hex FROM pages),
marked AS (SELECT *, max(page_id) OVER (PARTITION BY hex) AS first FROM p)
SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
           (CAST(concat('0x', substr(hex, CAST(1 + (i // 4) * 5 AS BIGINT), 5)) AS BIGINT)
             >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31 AS INTEGER), 1)), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM marked
"""


def op11_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("found", lambda p: p["kind"] != "literal")
    number = lambda kind: F.size(F.filter("found", lambda p: p["kind"] == kind)).cast("bigint")
    line = lambda ps: F.array_join(F.transform(ps, lambda p: F.concat_ws(":", p["kind"], p["start"], p["end"])), ",")
    return found.select(
        "doc_id",
        *[number(k).alias(f"n_{k}") for k in secrets.KINDS],
        F.sha2(line(base), 256).alias("base_sha256"),
        line(F.col("found")).alias("spans"),
    )


QUERIES["op11_secrets"] = op11_secrets


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.trie(*trie.regraft(trie.turns_of(table(spark, sf_dir, "conversations"))))


QUERIES["op12_prefix_trie"] = op12_prefix_trie
# crc32 of a short decimal, bit by bit; sequences are lists, a prefix is a slice.
ORACLES["op12_prefix_trie"] = """
WITH t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i,
         {'role': coalesce(role, ''), 'text': coalesce(text, '')} AS said
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, list(said ORDER BY i) AS own FROM t GROUP BY conv_id),
h AS (
  SELECT conv_id, own, xor(list_reduce(
    list_transform(range(1, 1 + len(CAST(conv_id AS VARCHAR))), lambda k: CAST(ascii(substr(CAST(conv_id AS VARCHAR), CAST(k AS BIGINT), 1)) AS BIGINT)),
    lambda crc, byte: list_reduce(range(8), lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(crc, byte)),
    CAST(4294967295 AS BIGINT)), 4294967295) % 9 AS h
  FROM c),
seqs AS (
  SELECT h.conv_id, list_concat(coalesce(b.own, [])[1:h.h], h.own[h.h + 1:]) AS s
  FROM h LEFT JOIN c b ON b.conv_id = h.conv_id - h.conv_id % 5),
members AS (SELECT conv_id, d, s[1:d] AS p, len(s) = d AS ends FROM (SELECT conv_id, s, unnest(range(0, len(s) + 1)) AS d FROM seqs)),
nodes AS (
  SELECT d, p, min(conv_id) AS conv_id, count(*) AS n,
         coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '') AS ended
  FROM members GROUP BY d, p),
kids AS (SELECT d - 1 AS d, p[1:d - 1] AS p, count(*) AS k FROM nodes WHERE d > 0 GROUP BY ALL),
own AS (
  SELECT n.*, coalesce(k, 0) AS k, CASE WHEN d = 0 THEN 0 ELSE (n - 1) * strlen(p[d].text) END AS saved
  FROM nodes n LEFT JOIN kids USING (d, p)),
below AS (
  SELECT a.d, a.p, count(*) FILTER (b.k = 0) AS leaves, sum(b.saved) AS saved
  FROM own a JOIN own b ON b.d >= a.d AND b.p[1:a.d] = a.p GROUP BY a.d, a.p)
SELECT o.conv_id, CAST(o.d AS BIGINT) AS depth, u.conv_id AS parent_conv_id, CAST(o.n AS BIGINT) AS n_convs,
       CAST(o.k AS BIGINT) AS n_children, CAST(leaves AS BIGINT) AS n_leaves, CAST(below.saved AS BIGINT) AS saved_tokens,
       sha256(o.ended) AS ends_sha256
FROM own o JOIN below ON below.d = o.d AND below.p = o.p LEFT JOIN own u ON u.d = o.d - 1 AND u.p = o.p[1:o.d - 1] AND o.d > 0
"""


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES["op13_alignment"] = op13_alignment
