"""Queries of this package: each operator over its whole table, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import own_folder
from winnow.llm import decontam, filter_audit, lengths, packing, pfor, pii, quality, secrets, simhash, substring, target_sampling
from winnow.llm import topk, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    own_folder(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return pfor.round_trip(table(spark, sf_dir, "documents"), path, end_id=2)


@query
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.find_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    names = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _count(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


@query
def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin(*pii.BASE))
    return found.select(
        "doc_id", *(_count("spans", k) for k in pii.BASE),
        F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"),
    )


@query
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(packing.pieces(table(spark, sf_dir, "documents"), path, end_id=0))


@query
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.weigh(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring.repeated_passages(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


@query
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return lengths.by_limit(lengths.histogram(lengths.encoded_lengths(table(spark, sf_dir, "documents"), path)))


@query
def op9_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


@query
def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    ranks = F.create_map(*(F.lit(x) for i, k in enumerate([*(b[0] for b in secrets.BASE), "random"]) for x in (k, i)))
    merged = F.sort_array(
        F.transform(
            F.concat("base", "random"),
            lambda s: F.struct(s["start"].alias("start"), ranks[s["kind"]].alias("rank"), s["kind"].alias("kind"), s["end"].alias("end")),
        )
    )
    return found.select(
        "doc_id", *(_count("base", k) for k, _, _, _ in secrets.BASE),
        F.sha2(_listed(F.col("base")), 256).alias("base_sha256"), _listed(merged).alias("spans"),
    )


@query
def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity.detect(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted", F.size("passages").cast("long").alias("n_passages"))


@query
def op12_target_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return target_sampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


SQL["op2_decontamination"] = r"""
WITH item_words AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL),
windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS size, unnest([array_to_string(w[i:i + least(10, len(w)) - 1], ' ')
    FOR i IN range(1, greatest(2, len(w) - 8))]) AS words FROM item_words WHERE len(w) > 0),
doc_words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
places AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM doc_words),
sizes AS (SELECT DISTINCT size FROM windows),
hits AS (
  SELECT p.doc_id, p.i, p.size, b.item_id FROM
    (SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS words FROM places, sizes
      WHERE i + size - 1 <= len(w)) p JOIN windows b ON p.size = b.size AND p.words = b.words),
hit_words AS (SELECT DISTINCT doc_id, unnest(range(i, i + size)) AS i FROM hits),
n_hits AS (SELECT doc_id, count(*) AS n FROM hit_words GROUP BY doc_id),
n_items AS (
  SELECT doc_id, count(*) AS n, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM hits WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(h.n, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(x.n, 0) AS BIGINT) AS n_items, sha256(coalesce(x.ids, '')) AS items_sha256,
  coalesce(h.n, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN n_hits h USING (doc_id) LEFT JOIN n_items x USING (doc_id)
"""

SQL["op7_substring_dedup"] = r"""
WITH doc_words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, unnest(range(1, len(w) - 11)) AS i,
    unnest([hash(array_to_string(w[k:k + 12], ' ')) FOR k IN range(1, len(w) - 11)]) AS h
  FROM doc_words WHERE len(w) > 12),
firsts AS (SELECT h, min(doc_id) AS least FROM windows GROUP BY h),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM windows JOIN firsts USING (h) WHERE least < doc_id),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM doc_words),
marked AS (SELECT words.*, gone.i IS NOT NULL AS removed FROM words LEFT JOIN gone USING (doc_id, i)),
kept AS (
  SELECT doc_id, count(*) FILTER (removed) AS n_removed,
    string_agg(word, ' ' ORDER BY i) FILTER (NOT removed) AS kept FROM marked GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM doc_words d LEFT JOIN kept USING (doc_id)
"""

SQL["op9_top_k"] = r"""
WITH vectors AS (
  SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
parts AS (SELECT vec_id, unnest(v) AS x, unnest(range(len(v))) AS i FROM vectors),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
  FROM parts q JOIN parts c ON q.i = c.i AND q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0 GROUP BY ALL),
ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
    vec_id, score FROM scores)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""

SQL["op12_target_sampling"] = r"""
WITH doc_words AS (
  SELECT row_number() OVER () AS place, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
raw_words AS (SELECT place, unnest(w) AS word FROM doc_words),
target_words AS (
  SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM benchmark),
bytes AS (
  SELECT word, [CAST('0x' || substr(hex(word), 2 * k - 1, 2) AS BIGINT) FOR k IN range(1, length(hex(word)) // 2 + 1)] AS b
  FROM (SELECT word FROM raw_words UNION SELECT word FROM target_words)),
crcs AS (
  SELECT word, xor(list_reduce(b, lambda c, x: list_reduce(range(8), lambda y, k:
      CASE WHEN y & 1 = 1 THEN xor(y >> 1, 3988292384) ELSE y >> 1 END, xor(c, x)), 4294967295), 4294967295) % 10000 AS bucket
  FROM bytes),
counts AS (
  SELECT bucket, sum(s) AS s, sum(t) AS t FROM (
    SELECT word, count(*) AS s, 0 AS t FROM raw_words GROUP BY word
    UNION ALL SELECT word, 0, count(*) FROM target_words GROUP BY word) JOIN crcs USING (word) GROUP BY bucket),
totals AS (SELECT CAST(coalesce(sum(s), 0) AS DOUBLE) AS s, CAST(coalesce(sum(t), 0) AS DOUBLE) AS t FROM counts),
gains AS (
  SELECT bucket, floor(1000 * ln((CAST(c.t AS DOUBLE) + 1) * (a.s + 10000) / ((CAST(c.s AS DOUBLE) + 1) * (a.t + 10000)))) AS gain
  FROM counts c, totals a),
weights AS (
  SELECT place, CAST(sum(gain) AS BIGINT) AS weight FROM raw_words JOIN crcs USING (word) JOIN gains USING (bucket) GROUP BY place),
scored AS (
  SELECT place, doc_id, CAST(len(w) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln(
    (CAST(CAST('0x' || left(sha256('2024:' || CAST(doc_id AS VARCHAR)), 8) AS BIGINT) AS DOUBLE) + CAST(0.5 AS DOUBLE)) / 4294967296.0))) AS BIGINT) AS score
  FROM doc_words LEFT JOIN weights USING (place)),
drawn AS (
  SELECT place, row_number() OVER (ORDER BY score DESC, doc_id, place) AS rank, 10 * count(*) OVER () // 100 AS n
  FROM scored WHERE n_features >= 20 AND doc_id IS NOT NULL)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= n THEN rank END AS rank
FROM scored LEFT JOIN drawn USING (place)
"""

SQL["op13_filter_audit"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
flags AS (
  SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
least AS (SELECT t, min(doc_id) AS first FROM d GROUP BY t),
masks AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, CAST(len(w) < 200 AS INTEGER)
    + 2 * CAST(100 * len(list_distinct(w)) < 50 * len(w) AS INTEGER)
    + 4 * CAST(100 * len(regexp_extract_all(d.t, '[A-Z]')) > 2 * length(d.t) AS INTEGER)
    + 8 * CAST(regexp_matches(d.t, '[#$%&*|]') AS INTEGER)
    + 16 * CAST(coalesce(d.doc_id > first, false) AS INTEGER) AS mask
  FROM d JOIN least ON d.t = least.t LEFT JOIN flags ON d.doc_id = flags.doc_id),
cells AS (
  SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM masks GROUP BY part, mask),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS o FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (
  SELECT o, i, CAST(coalesce(list_sum([1 << (ascii(o[j]) - 65) FOR j IN range(1, i)]), 0) AS INTEGER) AS prior,
    1 << (ascii(o[i]) - 65) AS own FROM orders, (SELECT unnest(range(1, 6)) AS i)),
counted AS (
  SELECT part, o, i, own,
    coalesce(sum(n) FILTER (mask & (prior | own) = 0), 0) AS kept,
    coalesce(sum(n) FILTER (mask & prior = 0 AND mask & own <> 0), 0) AS removed,
    coalesce(sum(n) FILTER (mask & prior <> 0 AND mask & own <> 0), 0) AS redundant,
    coalesce(sum(n) FILTER (mask = own), 0) AS unique_fails,
    coalesce(sum(good) FILTER (mask & prior = 0 AND mask & own <> 0), 0) AS good_lost,
    coalesce(sum(toxic) FILTER (mask & prior = 0 AND mask & own <> 0), 0) AS toxic_lost
  FROM cells, steps GROUP BY part, o, i, own)
SELECT part, o AS filter_order, CAST(i AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM counted
"""
