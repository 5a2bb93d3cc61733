"""The registered queries of the operators, over whole tables, and the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shipped, work_path, write_through
from .decontamination import find_overlaps
from .hard_negatives import hard_negatives
from .html_text import extract_text
from .lattice import near_duplicate_vectors
from .licenses import scan_licenses
from .line_dedup import dedup_lines
from .masked_lm import score, train, word_counts
from .minhash import near_duplicates
from .oracles import HARD_NEGATIVES, LICENSES, NEAR_DUPLICATES, NEAR_VECTORS, PREFIX_TRIE
from .packing import pack_documents
from .quality import features, rate_quality
from .sharding import shard
from .tokens import read_tokens, write_tokens
from .trie import prefix_trie, rebuilt, turn_lists


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = find_overlaps(docs, table(spark, sf_dir, "benchmark"), carry=False)
    return out.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


def op3_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), path)
    return read_tokens(spark, path)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    measured = write_through(features(docs).drop("text"), "quality")
    return rate_quality(docs, measured=measured).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "posterior"
    )


def op6_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op7_masked_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counts = word_counts(docs)
    return score(docs, train(docs, counts=counts), counts=counts)


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_shingles", "component_id", "kept")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    kept = F.sha2(F.coalesce("text", F.lit("")), 256)
    return out.select("doc_id", "n_lines", "n_dropped", kept.alias("kept_sha256"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = prefix_trie(rebuilt(turn_lists(table(spark, sf_dir, "conversations"))))
    return nodes.withColumn("depth", F.col("depth").cast("long"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").withColumn("label", shifted)
    return hard_negatives(rows, F.col("vec_id") % 100 == 0)


def op13_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


QUERIES = {
    f.__name__: shipped(f)
    for f in (
        op1_licenses, op2_decontamination, op3_token_ids, op4_packing, op5_quality,
        op6_html, op7_masked_lm, op8_minhash, op9_line_dedup, op10_sharding,
        op11_prefix_trie, op12_hard_negatives, op13_lattice,
    )
}

_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

ORACLES = {
    "op1_licenses": LICENSES,
    "op8_minhash": NEAR_DUPLICATES,
    "op11_prefix_trie": PREFIX_TRIE,
    "op12_hard_negatives": HARD_NEGATIVES,
    "op13_lattice": NEAR_VECTORS,
    "op2_decontamination": f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
sized AS (SELECT item_id, w, least(10, len(w)) AS n FROM i WHERE len(w) > 0),
known AS (
  SELECT DISTINCT item_id, n, array_to_string(w[p:p + n - 1], ' ') AS run
  FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS p FROM sized)
),
lengths AS (SELECT DISTINCT n FROM known),
runs AS (
  SELECT doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') AS run
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, lengths)
),
hits AS (SELECT doc_id, p, n, item_id FROM runs JOIN known USING (n, run)),
words AS (SELECT doc_id, count(DISTINCT p + j) AS n_hit FROM (SELECT doc_id, p, unnest(range(n)) AS j FROM hits) GROUP BY doc_id),
found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN found USING (doc_id)
""",
    "op9_line_dedup": """
WITH lines AS (
  SELECT doc_id, i, string_split(coalesce(text, ''), chr(10))[i] AS line
  FROM documents, LATERAL (SELECT unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) AS i)
), keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines
), often AS (
  SELECT k FROM keyed WHERE k <> '' GROUP BY k HAVING count(DISTINCT doc_id) >= 10
)
SELECT doc_id, count(*) AS n_lines, count(o.k) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (o.k IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN often o USING (k) GROUP BY doc_id
""",
}
