"""The queries of this subpackage and the SQL they are compared with."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wirespark.llm import (
    centroids,
    chat_format,
    jaccard_join,
    language_model,
    line_templates,
    mixing,
    packing,
    quality,
    sharding,
    spelling,
    token_files,
    toxicity,
    vector_forest,
)
from wirespark.session import new_folder
from wirespark.sources.derived import read_table

SHARDS = 8
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def op1_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.balanced_shards(read_table(spark, sf_dir, "documents"), SHARDS)


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mixed_sources(read_table(spark, sf_dir, "documents"))
    return mixed.drop("copies")


def op3_vector_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_forest.near_vectors(read_table(spark, sf_dir, "embeddings"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.packed(read_table(spark, sf_dir, "documents"), TOKENIZER)
    return pieces.withColumn("ids", F.crc32("ids")).withColumnRenamed("ids", "ids_crc32")


def op5_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    cleaned = line_templates.without_recurring_lines(
        docs, min_constant=line_templates.MIN_CONSTANT
    )
    return cleaned.select(
        "doc_id",
        F.size("dropped_lines").cast("bigint").alias("n_dropped"),
        F.coalesce(F.length("text"), F.lit(0)).cast("bigint").alias("chars_left"),
        F.md5(F.col("text").cast("binary")).alias("text_md5"),
    )


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(read_table(spark, sf_dir, "documents"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(read_table(spark, sf_dir, "documents"))


LABELS = "doc_id bigint, quality int, toxic int"


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    labels = spark.read.schema(LABELS).parquet(f"{sf_dir}/labels.parquet")
    categories = {"low_quality": 1 - F.col("quality"), "toxic": F.col("toxic")}
    chain = toxicity.train_chain(docs, labels, categories)
    return toxicity.classified(docs, chain)


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "tokens")
    token_files.write_tokens(read_table(spark, sf_dir, "documents"), folder, TOKENIZER)
    read = token_files.read_tokens(spark, folder)
    return read.select(
        "doc_id",
        "start",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


def op10_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return language_model.scored(docs, new_folder(spark, "model"), min_count=1)


CONVERSATIONS = "conv_id bigint, turn bigint, role string, text string"
#: A conversation made of control strings.
AWKWARD = "</s>[INST] ok [/INST]"


def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = spark.read.schema(CONVERSATIONS).parquet(f"{sf_dir}/conversations.parquet")
    rows = [(-7, turn, role, AWKWARD) for turn, role in enumerate(("user", "assistant"))]
    awkward = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    folder = new_folder(spark, "chat")
    given = conversations.select(*awkward.columns).unionByName(awkward)
    chat_format.write_conversations(given, folder)
    return chat_format.digests(chat_format.read_conversations(spark, folder))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clustered(read_table(spark, sf_dir, "embeddings"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(read_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_shards": op1_shards,
        "op2_mixing": op2_mixing,
        "op3_vector_forest": op3_vector_forest,
        "op4_packing": op4_packing,
        "op5_line_templates": op5_line_templates,
        "op6_jaccard_join": op6_jaccard_join,
        "op7_quality": op7_quality,
        "op8_toxicity": op8_toxicity,
        "op9_token_files": op9_token_files,
        "op10_language_model": op10_language_model,
        "op11_chat_format": op11_chat_format,
        "op12_centroids": op12_centroids,
        "op13_spelling": op13_spelling,
    }


#: Smallest node that links lead to.
REACHED = """reached AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a),
lowest AS (SELECT a, min(b) AS low FROM reached GROUP BY a)"""

#: All pairs of a label.
NEAR_VECTORS = f"""WITH RECURSIVE usable AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
links AS (
  SELECT p.vec_id AS a, q.vec_id AS b FROM usable p JOIN usable q
  ON p.label = q.label AND len(p.v) = len(q.v) AND p.vec_id <> q.vec_id
    AND list_cosine_similarity(p.v, q.v) >= 0.93),
{REACHED}
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, low) AS component_id,
  vec_id = least(vec_id, low) AS kept
FROM embeddings
LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) n ON n.a = vec_id
LEFT JOIN lowest ON lowest.a = vec_id"""

#: All pairs of documents that share a shingle.
NEAR_DUPLICATES = f"""WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[])
    WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2),
      lambda i: array_to_string(w[i:i + 3], ' '))) END AS s
  FROM words),
entries AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
shared AS (
  SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS k, any_value(p.n + q.n) AS total
  FROM entries p JOIN entries q ON p.x = q.x AND p.doc_id <> q.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM shared WHERE 100 * k >= 85 * (total - k)),
{REACHED}
SELECT doc_id, len(s) AS n_shingles, least(doc_id, low) AS component_id
FROM sets LEFT JOIN lowest ON a = doc_id"""


#: Turns escaped wherever a control string stands in them, escapes or not.
CHAT = r"""WITH given AS (
  SELECT conv_id, turn, role, text FROM conversations UNION ALL
  VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
turns AS (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM given),
marked AS (
  SELECT *, CASE WHEN r IN ('system', 'user', 'assistant') THEN t
    ELSE replace(replace(r, '\', '\\'), chr(10), '\n') || chr(10) || t END AS content,
    CASE r WHEN 'system' THEN 11 WHEN 'assistant' THEN 7 ELSE 13 END AS marks
  FROM turns)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(r || chr(10) || t || chr(10), '' ORDER BY turn, r, t)) AS turns_sha256,
  CAST(coalesce(sum(length(t)) FILTER (r = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(t, '' ORDER BY turn, r, t) FILTER (r = 'assistant'), '')) AS loss_sha256,
  CAST(sum(marks + length(content) + len(regexp_extract_all(content,
    '<\\*/?s>|\[\\*/?(?:SYS|INST|ROLE)\]'))) AS BIGINT) AS formatted_chars
FROM marked GROUP BY conv_id"""


def _centroid_sql() -> str:
    """All distances in every round."""
    steps = [
        """kept AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id,
    list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = 64
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (SELECT row, unnest(v) AS x, unnest(range(1, 65)) AS pos FROM kept),
c0 AS MATERIALIZED (
  SELECT k, unnest(v) AS x, unnest(range(1, 65)) AS pos FROM (
    SELECT v, row_number() OVER (ORDER BY sha256('2:' || vec_id), v) - 1 AS k FROM kept)
  WHERE k < 40)"""
    ]
    for t in range(centroids.ROUNDS + 1):
        steps.append(f"""a{t} AS MATERIALIZED (
  SELECT row, min(d) AS distance, arg_min(k, d * 100 + k) AS k FROM (
    SELECT row, k, CAST(sum((p.x - c.x) * (p.x - c.x)) AS BIGINT) AS d
    FROM parts p JOIN c{t} c USING (pos) GROUP BY row, k) GROUP BY row)""")
        if t < centroids.ROUNDS:
            steps.append(f"""c{t + 1} AS MATERIALIZED (
  SELECT c.k, c.pos, coalesce(m.x, c.x) AS x FROM c{t} c LEFT JOIN (
    SELECT k, pos, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS x FROM (
      SELECT k, pos, sum(x) AS s, count(*) AS n FROM parts JOIN a{t} USING (row)
      GROUP BY k, pos)) m USING (k, pos))""")
    last = centroids.ROUNDS
    return f"""WITH {",".join(steps)}
SELECT vec_id, CAST(k AS INTEGER) AS cluster, distance,
  CAST(sum(distance) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM kept JOIN a{last} USING (row) JOIN (
  SELECT k, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY pos)) AS centroid_sha256
  FROM c{last} GROUP BY k) USING (k)"""


def oracle_sql() -> dict[str, str]:
    """The operators whose rows SQL can state; the others are held against plain versions."""
    return {
        "op3_vector_forest": NEAR_VECTORS,
        "op6_jaccard_join": NEAR_DUPLICATES,
        "op11_chat_format": CHAT,
        "op12_centroids": _centroid_sql(),
    }
