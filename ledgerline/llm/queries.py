"""Registered queries of the subpackage: thin calls of its operators over whole driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import bpe, collocations, decontaminate, languages, lengths, licences, multiindex, neardup, negatives, records, sharding, substrings, toxicity
from ledgerline.llm.common import table
from ledgerline.session import scratch_path

QUERIES = {}
ORACLE_SQL: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op2_nnpu_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train_on_labels(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model)
    return scored.select("row.doc_id", toxicity.held_out("row.doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op4_length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lengths.length_table(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


@query
def op8_fm_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find(docs, table(spark, sf_dir, "benchmark"))
    n_hit = F.expr("aggregate(sequence(1, size(spans), 2), 0L, (a, i) -> a + spans[i] - spans[i - 1])")
    return found.select(
        "row.doc_id",
        "n_words",
        F.when(F.size("spans") > 0, n_hit).otherwise(F.lit(0).cast("long")).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


@query
def op9_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "records")
    index = records.write_records(table(spark, sf_dir, "documents"), path, vocabulary("word_bpe_49k.json"), end_id=2)
    read = records.with_starts(records.read_records(index, path), index)
    return read.select(F.col("id").alias("doc_id"), "start", "n_tokens", "ids_crc32")


@query
def op10_bpe_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = bpe.encode_decode(docs, vocabulary("byte_bpe_50k.json"))
    return out.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op7_hamming_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = neardup.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), shingle_words=4, percent=80)
    return out.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", (F.col("id") == F.col("component_id")).alias("kept"))


@query
def op6_interval_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substrings.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), length=100)
    return out.select(
        "row.doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.expr("size(spans) div 2").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query
def op1_multi_index_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = multiindex.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, k=20)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


SHARD_BYTES = 1 << 20


@query
def op3_extendible_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = table(spark, sf_dir, "documents"), scratch_path(spark, "shards")
    sharding.write_shards(docs, SHARD_BYTES, path)
    return sharding.read_shards(docs, path).select("row.doc_id", "n_bytes", "shard", "depth", "shard_bytes")


ORACLE_SQL["op3_extendible_shards"] = f"""
WITH places AS (
  SELECT doc_id, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n_bytes,
         lpad(bin(CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 15) AS BIGINT)), 60, '0') AS bits
  FROM documents),
levels AS (
  SELECT d.depth, substr(bits, 1, d.depth) AS shard, CAST(sum(n_bytes) AS BIGINT) AS shard_bytes, count(*) AS n
  FROM places, (SELECT CAST(range AS INTEGER) AS depth FROM range(0, 61)) AS d GROUP BY ALL),
fitting AS (SELECT * FROM levels WHERE shard_bytes <= {SHARD_BYTES} OR n <= 1),
choice AS (
  SELECT doc_id, n_bytes, f.shard, f.depth, f.shard_bytes,
         row_number() OVER (PARTITION BY doc_id ORDER BY f.depth) AS k
  FROM places JOIN fitting AS f ON substr(bits, 1, f.depth) = f.shard)
SELECT doc_id, n_bytes, shard, depth, shard_bytes FROM choice WHERE k = 1
"""


@query
def op5_licence_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = licences.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    family = F.array_sort(F.array_distinct(F.col("licences.family")))
    return out.select("row.doc_id", F.size("licences").cast("long").alias("n_paragraphs"), F.array_join(family, ",").alias("families"), F.round(F.array_min("licences.prob"), 3).alias("lowest_prob"), F.round(F.array_min("licences.alike"), 3).alias("lowest_alike"))


@query
def op11_string_kernel_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = languages.predict(docs, languages.train(docs))
    return found.select(F.col("id").alias("doc_id"), languages.held_out("id").alias("held_out"), "lang_pred", "score")


@query
def op12_son_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents").select("text", "lang"), support=100, top=2000)


# Words and pieces as in the operator; every phrase of one to five words is counted, without any pruning.
ORACLE_SQL["op12_son_collocations"] = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
worded AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM worded GROUP BY lang),
spans AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM worded),
counted AS (
  SELECT lang, array_to_string(w[i:i + size - 1], ' ') AS phrase, CAST(size AS INTEGER) AS size, count(*) AS f
  FROM spans, (SELECT unnest(range(1, 6)) AS size) AS sizes WHERE i + size - 1 <= len(w) GROUP BY ALL HAVING count(*) >= 100),
cuts AS (
  SELECT c.lang, c.phrase, c.f AS a, k, l.f AS l, r.f AS r, n,
         (1000::HUGEINT * c.f * n) // (l.f::HUGEINT * r.f) AS score
  FROM (SELECT *, string_split(phrase, ' ') AS w, unnest(range(1, size)) AS k FROM counted WHERE size > 1) AS c
  JOIN counted AS l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:k], ' ')
  JOIN counted AS r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[k + 1:], ' ')
  JOIN totals AS t ON t.lang = c.lang),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_phrases AS (
  SELECT DISTINCT o.lang, o.phrase
  FROM (SELECT lang, f, w, size, unnest(range(1, size + 1)) AS i FROM (SELECT *, string_split(phrase, ' ') AS w FROM counted WHERE size > 2)) AS b,
       (SELECT unnest(range(2, 5)) AS part) AS parts
  JOIN counted AS o ON o.lang = b.lang AND o.phrase = array_to_string(b.w[b.i:b.i + part - 1], ' ')
  WHERE part < b.size AND b.i + part - 1 <= b.size AND 100 * b.f >= 100 * o.f),
ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
  FROM lowest ANTI JOIN inner_phrases USING (lang, phrase))
SELECT * FROM ranked WHERE rank <= 2000
"""


@query
def op13_strassen_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, label)


ORACLE_SQL["op13_strassen_negatives"] = """
WITH used AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
         CAST(list_sum(list_transform(list_zip(a.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM used AS a JOIN used AS c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives AS p JOIN scores AS s ON s.anchor_id = p.anchor_id AND NOT same
 AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""
