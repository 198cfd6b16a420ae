"""The operators over the given tables, and the SQL that must give the same rows where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from matchlytics.llm.centroids import cluster
from matchlytics.llm.common import crc_mod, stored
from matchlytics.llm.decontaminate import decontaminate
from matchlytics.llm.language_id import languages
from matchlytics.llm.lm import score_documents
from matchlytics.llm.phrases import remove_later_passages
from matchlytics.llm.prefix_trie import KEY, build_trie, ends_digests, forked, numbered
from matchlytics.llm.quality_classifier import quality_scores
from matchlytics.llm.quality_rules import STATISTICS, verdicts
from matchlytics.llm.sentencepiece import round_trip_digests
from matchlytics.llm.simhash import classes_of, fingerprints
from matchlytics.llm.suffix_dedup import remove_repeated_strings
from matchlytics.llm.toxicity import toxicity_scores
from matchlytics.llm.url_filter import filter_urls

MODEL = public_tokenizers.path("piece_bpe_32k.model")

#: Verdict, host and path of each rule (fixed values).
URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[build.__name__] = build
        if sql:
            ORACLES[build.__name__] = sql
        return build

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def digest(c: Column | str) -> Column:
    return F.sha2((F.col(c) if isinstance(c, str) else c).cast("binary"), 256)


@query()
def op1_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return round_trip_digests(table(spark, folder, "documents").select("doc_id", "text"), MODEL)


@query()
def op2_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeated_strings(table(spark, folder, "documents").select("doc_id", "text")).select(
        "doc_id",
        "n_bytes",
        F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["b"] - s["a"]).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        digest("kept").alias("kept_sha256"),
    )


@query()
def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    own = stored(fingerprints(table(spark, folder, "documents")))
    return own.join(classes_of(own, "doc_id"), "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query("""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
i AS (SELECT item_id, w, least(10, len(w)) AS k FROM b WHERE len(w) > 0),
v AS (
  SELECT DISTINCT item_id, k, array_to_string(w[s:s + k - 1], ' ') AS g
  FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM i)),
x AS (
  SELECT doc_id, k, s, array_to_string(w[s:s + k - 1], ' ') AS g
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM d, (SELECT DISTINCT k FROM i) WHERE len(w) >= k)),
m AS (SELECT x.doc_id, v.item_id, x.s, x.k FROM x JOIN v USING (k, g)),
h AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(s, s + k)) AS p FROM (SELECT DISTINCT doc_id, s, k FROM m)) GROUP BY doc_id),
j AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM m) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN j USING (doc_id)
""")
def op4_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return decontaminate(docs, table(spark, folder, "benchmark")).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        digest(F.concat_ws(",", "items")).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query("""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
g AS (
  SELECT doc_id, s, md5(array_to_string(w[s:s + 19], ' ')) AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS s FROM d WHERE len(w) >= 20)),
m AS (SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY g ORDER BY doc_id, s) AS k FROM g) WHERE k > 1),
r AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS p FROM m),
n AS (SELECT doc_id, count(*) AS n_removed, list(p) AS gone FROM r GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
  sha256(coalesce(array_to_string(
    CASE WHEN gone IS NULL THEN w ELSE list_filter(w, lambda x, i: NOT list_contains(gone, i)) END, ' '), '')) AS kept_sha256
FROM d LEFT JOIN n USING (doc_id)
""")
def op6_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return remove_later_passages(table(spark, folder, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["b"] - s["a"]).alias("n_removed"), digest("kept").alias("kept_sha256")
    )


@query("""
WITH d AS (SELECT doc_id, coalesce(source, chr(0)) AS host, coalesce(text, '') AS t, text FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w FROM d),
g AS (
  SELECT doc_id, s, array_to_string(w[s:s + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS s FROM w WHERE len(w) >= 5)),
r AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT doc_id, unnest(range(s, s + 5)) AS p FROM (SELECT doc_id, s, count(*) OVER (PARTITION BY doc_id, g) AS n FROM g) WHERE n > 1)
  GROUP BY doc_id),
l AS (SELECT doc_id, host, text, line FROM (SELECT doc_id, host, text, unnest(string_split(t, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
u AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM l GROUP BY doc_id),
k AS (
  SELECT doc_id, host, text, trim(regexp_replace(lower(line), '[\\x20\\x09-\\x0D0-9]+', ' ', 'g')) AS key, length(line) AS chars FROM l),
c AS (SELECT host, count(*) AS docs FROM (SELECT DISTINCT host, doc_id, text FROM d) GROUP BY host),
a AS (
  SELECT host, key, first FROM (
    SELECT host, key, count(DISTINCT doc_id) AS found, count(DISTINCT text) AS texts, min(doc_id) AS first FROM k GROUP BY host, key)
  JOIN c USING (host) WHERE found > 20 AND texts > 1
    AND (found > docs * 0.03 OR (found > 200 AND len(string_split(key, ' ')) >= 5))),
x AS (
  SELECT doc_id, count(*) AS n, sum(chars) AS chars FROM k JOIN a USING (host, key) WHERE doc_id <> first GROUP BY doc_id),
s AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
    CAST(coalesce(length(array_to_string(w, '')), 0) AS BIGINT) AS word_chars,
    CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
    length(t) AS size, coalesce(n, 0) AS n_lines_removed, CAST(coalesce(chars, 0) AS BIGINT) AS chars_removed
  FROM w LEFT JOIN r USING (doc_id) LEFT JOIN u USING (doc_id) LEFT JOIN x USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND NOT chars_removed > size * 0.7 AS kept,
  n_lines_removed, chars_removed
FROM s
""")
def op7_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return verdicts(table(spark, folder, "documents")).select(F.col("_id").alias("doc_id"), *STATISTICS, "kept", "n_lines_removed", "chars_removed")


@query()
def op5_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    scores = score_documents(table(spark, folder, "documents"), crc_mod("doc_id", 10) != 0)
    return scores.select("doc_id", (crc_mod("doc_id", 10) == 0).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query()
def op8_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    labels = table(spark, folder, "labels").where(crc_mod("doc_id", 3) != 1)
    return quality_scores(table(spark, folder, "documents"), labels).select(
        "doc_id", (crc_mod("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


@query()
def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    labels = table(spark, folder, "labels").where(crc_mod("doc_id", 4) != 2)
    return toxicity_scores(table(spark, folder, "documents"), labels).select(
        "doc_id", (crc_mod("doc_id", 4) == 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


@query()
def op10_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    return filter_urls(table(spark, folder, "pages").select("page_id", "url"), URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def _clustering_sql(clusters: int = 16, rounds: int = 3) -> str:
    """The rounds one after the other; ``//`` and ``%`` round towards zero, hence the correction."""
    gap = "list_sum(list_transform(range(1, 65), lambda j: (v.x[j] - c.x[j]) * (v.x[j] - c.x[j])))"
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (
  SELECT row, vec_id, x, k, d FROM (
    SELECT v.row, v.vec_id, v.x, c.k, {gap} AS d FROM v, c{r} c)
  QUALIFY row_number() OVER (PARTITION BY row ORDER BY d, k) = 1)""")
        if r < rounds:
            steps.append(f"""s{r} AS (
  SELECT k, list((t - ((t % n) + n) % n) // n ORDER BY j) AS x FROM (
    SELECT k, j, sum(y) AS t, count(*) AS n FROM (SELECT k, unnest(x) AS y, unnest(range(1, 65)) AS j FROM a{r}) GROUP BY k, j)
  GROUP BY k),
c{r + 1} AS MATERIALIZED (SELECT c.k, CAST(coalesce(s.x, c.x) AS BIGINT[]) AS x FROM c{r} c LEFT JOIN s{r} s USING (k))""")
    return f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda y: CAST(floor(64 * CAST(y AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda y: y IS NULL OR NOT isfinite(y))) = 0),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('1:' || CAST(vec_id AS VARCHAR)), x) - 1 AS k, x FROM v
  QUALIFY k < {clusters}),
{", ".join(steps)},
p AS (SELECT k, sum(d) AS own FROM a{rounds} GROUP BY k)
SELECT vec_id, CAST(k AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(own AS BIGINT) AS cluster_inertia,
  CAST((SELECT sum(own) FROM p) AS BIGINT) AS inertia, sha256(array_to_string(list_transform(c.x, lambda y: CAST(y AS VARCHAR)), ',')) AS centroid_sha256
FROM a{rounds} JOIN p USING (k) JOIN c{rounds} c USING (k)"""


@query(_clustering_sql())
def op11_centroid_clustering(spark: SparkSession, folder: str) -> DataFrame:
    return cluster(table(spark, folder, "embeddings"), keep=["vec_id"]).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", digest(F.concat_ws(",", "centroid")).alias("centroid_sha256")
    )


@query()
def op12_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return languages(table(spark, folder, "documents"), crc_mod("doc_id", 3) != 1).select("doc_id", (crc_mod("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")


@query("""
WITH o AS (
  SELECT conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')} ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS w
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
f AS (
  SELECT conv_id, w, CAST(xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT))),
    lambda a, b: list_reduce(list_prepend(xor(a, b), CAST(range(8) AS BIGINT[])), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) AS BIGINT) % 4 AS h
  FROM o),
c AS (
  SELECT f.conv_id, list_concat(coalesce(b.w[:f.h], []), f.w[f.h + 1:]) AS w
  FROM f LEFT JOIN o b ON b.conv_id = f.conv_id - f.conv_id % 20),
n AS (
  SELECT d, w[:d] AS p, min(conv_id) AS conv_id, count(*) AS n, list(conv_id ORDER BY conv_id) FILTER (len(w) = d) AS ends
  FROM (SELECT conv_id, w, unnest(range(len(w) + 1)) AS d FROM c) GROUP BY ALL),
k AS (SELECT d - 1 AS d, p[:d - 1] AS p, count(*) AS k FROM n WHERE d > 0 GROUP BY ALL),
m AS (
  SELECT n.*, coalesce(k, 0) AS k, CASE WHEN d > 0 THEN (n.n - 1) * len(regexp_extract_all(p[d].t, '[^\\x20\\x09-\\x0D]+')) ELSE 0 END AS saved
  FROM n LEFT JOIN k USING (d, p)),
s AS (SELECT a AS d, p[:a] AS p, sum(saved) AS saved, count(*) FILTER (k = 0) AS leaves FROM (SELECT *, unnest(range(d + 1)) AS a FROM m) GROUP BY ALL)
SELECT m.conv_id, m.d AS depth, u.conv_id AS parent_conv_id, m.n AS n_convs, m.k AS n_children, s.leaves AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens,
  sha256(coalesce(array_to_string(list_transform(m.ends, lambda e: CAST(e AS VARCHAR)), ','), '')) AS ends_sha256
FROM m JOIN s USING (d, p) LEFT JOIN n u ON u.d = m.d - 1 AND u.p = m.p[:m.d - 1]
""")
def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    turns, convs = forked(numbered(table(spark, folder, "conversations")), 20, 4)
    trie = build_trie(turns, convs)
    return trie.nodes.join(ends_digests(trie.ends), KEY, "left").select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", digest(F.lit(""))).alias("ends_sha256"),
    )
