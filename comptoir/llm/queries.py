"""One registered query per operator: ``(spark, sf_dir) -> DataFrame`` over the whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from comptoir.llm import bpe, decontam, hard_negatives, imatch, license_scan, line_dedup, mixing, quality, sharding
from comptoir.llm import simhash, substring_dedup, url_filter, whitening
from comptoir.llm.common import table
from comptoir.session import scratch_path

SHARDS = 16
TOKENIZER = "byte_bpe_multi_50k.tiktoken"


def tokenizer() -> tuple[str, str]:
    """(path of the rank file, pattern) of the public tokenizer."""
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER), public_tokenizers.PATTERN


def hex64(c: Column) -> Column:
    """A long as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(c), 16, "0"))


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs, min_chars=20, min_docs=3).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "llm", "slot_map")
    return sharding.shard_records(table(spark, sf_dir, "documents"), SHARDS, path).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", F.col("version").alias("map_version"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.classify(docs, table(spark, sf_dir, "labels")).drop("text")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    hits = decontam.find_hits(docs, table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate(F.arrays_zip("hit_starts", "hit_ends"), F.lit(0).cast("long"),
                        lambda n, s: n + s["hit_ends"] - s["hit_starts"])
    return hits.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("hit_items").cast("long").alias("n_items"),
                       F.sha2(F.array_join(F.array_sort("hit_items"), ","), 256).alias("items_sha256"),
                       (F.size("hit_starts") > 0).alias("contaminated"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.remove_repeats(docs, window_words=50).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op8_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.fingerprint_documents(table(spark, sf_dir, "documents"))


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle_words=3, max_bits=3)
    return groups.select("doc_id", hex64(F.col("fp")).alias("fingerprint"), "component_id")


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode_decode(docs, *tokenizer()).drop("text")


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    model = whitening.fit(vectors, components=32)
    if model is None:
        return spark.createDataFrame([], "vec_id bigint, component int, n bigint, deviation bigint, whitened double, "
                                         "explained double, identity_error double")
    error = whitening.identity_error(vectors, model)
    explained = F.array(*(F.lit(float(e)) for e in model.explained))
    return (whitening.transform(vectors.select("vec_id", "embedding"), model)
            .select("vec_id", "n", F.col("deviation").try_cast("bigint").alias("deviation"), F.posexplode("whitened").alias("at", "whitened"))
            .select("vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", "whitened",
                    F.get(explained, F.col("at")).alias("explained"), F.lit(error).alias("identity_error")))


def op12_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.taken(*mixing.mixture(table(spark, sf_dir, "documents"), weights=(5, 2, 1), most_repeats=3))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_license_scan, op2_line_dedup, op3_url_filter, op4_sharding, op5_quality_classifier, op6_decontamination,
        op7_substring_dedup, op8_document_fingerprints, op9_simhash_near_dedup, op10_byte_bpe,
        op11_embedding_whitening, op12_source_mixing, op13_hard_negatives)}

#: White space of the line keys of op2, words of op6 and lower case in DuckDB.
_BLANK = r"[\x20\x09-\x0D]"
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_ASCII = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

ORACLE: dict[str, str] = {
    "op2_line_dedup": rf"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS nth
  FROM documents),
keyed AS (
  SELECT doc_id, line, nth,
         translate(regexp_replace(regexp_replace(line, '^{_BLANK}+', ''), '{_BLANK}+$', ''), {_ASCII}) AS k
  FROM lines),
repeats AS (
  SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 20
  GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
judged AS (
  SELECT keyed.doc_id, line, nth, coalesce(keyed.doc_id <> keeper, false) AS goes
  FROM keyed LEFT JOIN repeats USING (k))
SELECT doc_id, count(*) AS n_lines, CAST(sum(CAST(goes AS INTEGER)) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY nth) FILTER (WHERE NOT goes), '')) AS kept_sha256
FROM judged GROUP BY doc_id""",
    "op6_decontamination": rf"""
WITH items AS (
  SELECT item_id, regexp_extract_all(translate(text, {_ASCII}), '{_WORD}') AS w FROM benchmark),
grams AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n,
         array_to_string(w[pos:pos + least(len(w), 10) - 1], ' ') AS gram
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS pos FROM items WHERE len(w) > 0)),
docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_ASCII}), '{_WORD}') AS w FROM documents),
sizes AS (SELECT DISTINCT n FROM grams),
places AS (
  SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS pos FROM docs, sizes WHERE len(w) >= n),
hits AS (
  SELECT doc_id, pos, grams.n, item_id FROM places, grams
  WHERE places.n = grams.n AND array_to_string(w[pos:pos + places.n - 1], ' ') = gram),
words AS (
  SELECT doc_id, count(DISTINCT word) AS n_hit
  FROM (SELECT doc_id, unnest(range(pos, pos + n)) AS word FROM hits) GROUP BY doc_id),
found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN words USING (doc_id) LEFT JOIN found USING (doc_id)""",
    "op7_substring_dedup": rf"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, pos, sha256(array_to_string(w[pos:pos + 49], ' ')) AS gram
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS pos FROM docs WHERE len(w) >= 50)),
firsts AS (SELECT gram, min(doc_id) AS first_doc FROM windows GROUP BY gram),
covered AS (
  SELECT DISTINCT doc_id, unnest(range(pos, pos + 50)) AS nth FROM windows JOIN firsts USING (gram)
  WHERE first_doc < doc_id),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS nth FROM docs),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY nth) AS kept_text
  FROM words ANTI JOIN covered USING (doc_id, nth) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept_text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)""",
    # Sources in order of the level at which they are full; those before the first that stays below are cut to their most.
    "op12_source_mixing": r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         sha256(concat(coalesce(CAST(doc_id AS VARCHAR), ''), ':', coalesce(text, ''))) AS draws
  FROM documents),
sources AS (
  SELECT source, source_size, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
  FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source)),
ranked AS (
  SELECT *, sum(source_size) OVER () AS total, sum(weight) OVER () AS weights,
         coalesce(sum(3 * source_size) OVER (ORDER BY source_size / weight, source NULLS LAST
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cut,
         coalesce(sum(weight) OVER (ORDER BY source_size / weight, source NULLS LAST
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS weight_cut
  FROM sources),
level AS (
  SELECT coalesce(min_by(lvl, cut), 0) AS lvl
  FROM (SELECT cut, CAST(total - cut AS DOUBLE) / CAST(weights - weight_cut AS DOUBLE) AS lvl, weight, source_size FROM ranked)
  WHERE weight * lvl <= 3 * source_size),
rated AS (
  SELECT source, source_size, least(weight * lvl, CAST(3 * source_size AS DOUBLE)) AS target,
         CASE WHEN source_size > 0 THEN least(weight * lvl, CAST(3 * source_size AS DOUBLE)) / source_size ELSE 0 END AS rate
  FROM sources, level),
tried AS (
  SELECT doc_id, sized.source, size, source_size, target, seed, size * CAST(floor(rate) +
         CAST(CAST(CAST('0x' || draws[seed * 8 + 1:seed * 8 + 8] AS BIGINT) AS DOUBLE) / 4294967296.0 < rate - floor(rate) AS INTEGER) AS BIGINT) AS taken
  FROM sized JOIN rated ON sized.source IS NOT DISTINCT FROM rated.source, (SELECT unnest(range(8)) AS seed)),
seeds AS (
  SELECT source, seed FROM (SELECT source, seed, row_number() OVER (PARTITION BY source ORDER BY abs(sum(taken) - any_value(target)), seed) AS nth
                            FROM tried GROUP BY source, seed) WHERE nth = 1)
SELECT doc_id, size, source_size, target, taken
FROM tried JOIN seeds ON tried.source IS NOT DISTINCT FROM seeds.source AND tried.seed = seeds.seed""",
    "op13_hard_negatives": """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id AS id, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM rows AS a, rows AS b WHERE a.vec_id % 50 = 0 AND a.vec_id IS DISTINCT FROM b.vec_id),
positives AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS nth FROM scores WHERE same)
  WHERE nth <= 5)
SELECT anchor_id, positive_id, CAST(nth AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM (
  SELECT p.anchor_id, p.id AS positive_id, n.id AS negative_id, p.score AS positive_score, n.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id) AS nth
  FROM positives AS p JOIN scores AS n
    ON p.anchor_id = n.anchor_id AND NOT n.same AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score)
WHERE nth <= 3""",
}
