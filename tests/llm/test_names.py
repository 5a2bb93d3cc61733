"""Columns with dots, backticks and the names that operators use inside."""

import pytest
from pyspark.sql import functions as F

from rowferry.llm import masked_lm
from rowferry.llm.decontamination import find_overlaps
from rowferry.llm.hard_negatives import hard_negatives
from rowferry.llm.html_text import extract_text
from rowferry.llm.lattice import near_duplicate_vectors
from rowferry.llm.licenses import scan_licenses
from rowferry.llm.line_dedup import dedup_lines
from rowferry.llm.minhash import near_duplicates
from rowferry.llm.packing import pack_documents
from rowferry.llm.quality import rate_quality
from rowferry.llm.sharding import shard
from rowferry.llm.trie import prefix_trie, turn_lists

ODD = ["a.b", "x`y", "a b"]
INNER = ["node", "label", "stays", "row", "key", "item", "line", "word", "spans", "kept", "posterior", "n_lines", "copy", "task", "shard", "group", "ids"]


def lm(docs):
    return masked_lm.score(docs, masked_lm.MaskedModel(*masked_lm.vocabulary(masked_lm.word_counts(docs)), masked_lm.start_weights()))


OPERATORS = {
    "licenses": scan_licenses, "overlaps": lambda d: find_overlaps(d, d.select(F.col("doc_id").alias("item_id"), "text")), "packing": pack_documents,
    "quality": rate_quality, "html": lambda d: extract_text(d.withColumnRenamed("text", "html")), "lm": lm, "minhash": near_duplicates, "lines": dedup_lines, "sharding": shard,
    "trie": lambda d: prefix_trie(turn_lists(d.withColumnsRenamed({"doc_id": "conv_id"}).withColumns({"turn": F.lit(1), "role": F.lit("u")}))),
    "negatives": lambda d: hard_negatives(d.withColumns({"vec_id": F.col("doc_id"), "embedding": F.array(F.lit(1.0)), "label": F.lit(1)}), F.lit(True)),
    "vectors": lambda d: near_duplicate_vectors(d.withColumns({"vec_id": F.col("doc_id"), "embedding": F.array(F.lit(1.0))})),
}
CARRY = {"overlaps", "quality", "html", "lm", "minhash", "lines"}


@pytest.mark.parametrize("name", list(OPERATORS))
def test_any_column_may_come_along(spark, name):
    docs = spark.createDataFrame([(i, "one two three four five six", "v") for i in range(3)], "doc_id long, text string, v string")
    docs = docs.select("doc_id", "text", *[F.col("v").alias(c) for c in [*ODD, *INNER]])
    out = OPERATORS[name](docs)
    rows = out.collect()
    assert rows or name == "negatives"
    if name in CARRY:
        assert set(ODD) <= set(out.columns) and all(r[c] == "v" for r in rows for c in ODD)
