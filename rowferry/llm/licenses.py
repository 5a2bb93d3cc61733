"""Operator 1: license templates in text blocks, by an exact set-similarity join. Built-in expressions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    """Words to find. A block matches when it holds at least ``percent`` of the distinct ones; of a ``phrase`` all,
    and then only the places count where they stand one after the other."""

    label: str
    words: str
    percent: int = 100
    phrase: bool = False

    @property
    def tokens(self) -> list[str]:
        return sorted(set(self.words.split()))

    @property
    def need(self) -> int:
        return -(-len(self.tokens) * self.percent // 100)


TEMPLATES = (
    Template("cc-by", "cc by", phrase=True),
    Template("gpl", "general public license", phrase=True),
    Template("reserved", "all rights reserved", phrase=True),
    Template("apache-2.0", "licensed under the apache license version 2 0"),
    Template("cc-by-nc", "licensed under cc by nc 4 0"),
    Template("gpl-3.0", "licensed under the gnu general public license version 3"),
    Template("mit", "released under the mit license"),
    Template("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", 90),
    Template("mit-text", "permission is hereby granted free of charge to any person obtaining a copy of this software", 80),
    Template("bsd-text", "redistribution and use in source and binary forms with or without modification are permitted", 80),
    Template("apache-text", "distributed on an as is basis without warranties or conditions of any kind", 80),
)
#: A block starts every STEP words and is two steps long, so every run of STEP + 1 words lies in one block.
STEP = 32


def _strings(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def token_order(words: DataFrame, vocabulary: list[str]) -> list[str]:
    """The templates' tokens, rarest first, by the number of documents that hold them. One count per token."""
    seen = (
        words.select(F.explode(F.array_intersect(_strings(vocabulary), "_words")).alias("token"))
        .groupBy("token")
        .count()
        .collect()
    )
    counts = {r.token: r["count"] for r in seen}
    return sorted(vocabulary, key=lambda t: (counts.get(t, 0), t))


def _consecutive(block: Column, words: list[str]) -> Column:
    """Places in the first half of a block where the words stand; each place of a text is in one first half."""

    def here(i: Column) -> Column:
        found = F.get(block, i) == F.lit(words[0])
        for k, word in enumerate(words[1:], 1):
            found = found & F.coalesce(F.get(block, i + k) == F.lit(word), F.lit(False))
        return found

    last = F.least(F.lit(STEP), F.size(block)) - 1
    return F.filter(F.sequence(F.lit(0), last), here)


def scan_licenses(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``n_words``, places of the phrases (``n_base``, ``first_word``, ``last_word``),
    ``base_labels``, ``labels`` and ``score``, the largest share of a template that a block holds.

    A block can only hold enough of a template if it holds one of its prefix, the ``size - need + 1`` globally rarest
    of its tokens. Documents without any prefix token are done after one look at their words. Others are cut into
    blocks around those tokens; block tokens in global order meet the prefixes in an equi-join; the length and
    positional filters drop pairs that cannot reach the threshold, and the rest are compared in full. The templates
    are constants of this module or few rows of the caller, so they are broadcast.

    Words are found after lower-casing. ``lower`` also folds letters beyond ASCII, which changes neither where words
    begin and end nor which words are those of an all-ASCII template: only the Kelvin sign folds to an ASCII letter
    alone, and it is put aside before.
    NULL text counts as empty and has no words, labels or score above 0. Repeated rows and ids are rows of their own,
    NULL ids are carried. Other columns are not read.
    """
    if any(len(t.words.split()) > STEP + 1 for t in templates):
        raise ValueError(f"a template has at most {STEP + 1} words")
    spark = docs.sparkSession
    text = F.lower(F.replace(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), F.lit("\u212a"), F.lit("\u212b")))
    rows = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.array_remove(F.split(text, NOT_WORD, -1), "").alias("_words")
    )
    order = token_order(rows, sorted({w for t in templates for w in t.tokens}))
    rank = {t: i for i, t in enumerate(order)}
    ranked = [(t, sorted(t.tokens, key=rank.get)) for t in templates]
    prefixes = [
        (number, i, token)
        for number, (t, tokens) in enumerate(ranked)
        for i, token in enumerate(tokens[: len(tokens) - t.need + 1])
    ]
    first_tokens = _strings(sorted({p[2] for p in prefixes}))
    sides = spark.range(1).select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(token).alias("token"),
                        F.lit(i).alias("i"),
                        F.lit(number).alias("template"),
                        _strings(ranked[number][1]).alias("t_tokens"),
                        F.lit(ranked[number][0].need).alias("need"),
                    )
                    for number, i, token in prefixes
                ]
            )
        )
    )
    rows = rows.withColumn("_row", F.monotonically_increasing_id())
    found = F.filter(
        F.transform("_words", lambda w, i: F.when(F.array_contains(first_tokens, w), i)), lambda i: i.isNotNull()
    )
    rows = rows.select(
        "_row", "doc_id", F.size("_words").alias("n_words"), "_words",
        F.when(F.arrays_overlap("_words", first_tokens), found).alias("at"),
    )
    step = F.lit(STEP)
    numbers = F.array_distinct(
        F.flatten(F.transform("at", lambda i: F.array((i - i % step) / step, (i - i % step) / step - 1).cast("array<int>")))
    )
    rows = rows.select("_row", "doc_id", "n_words", "_words", F.filter(numbers, lambda b: b >= 0).alias("numbers"))
    cut = F.transform(
        "numbers", lambda b: F.struct(b.alias("number"), F.slice("_words", b * step + 1, 2 * STEP).alias("words"))
    )
    blocks = rows.select("_row", "doc_id", "n_words", F.explode_outer(cut).alias("block"))
    blocks = blocks.select(
        "_row", "doc_id", "n_words", (F.col("block.number") * step).alias("base"), F.col("block.words").alias("words"),
        F.array_intersect(_strings(order), "block.words").alias("tokens"),
    )
    blocks = blocks.select("*", F.posexplode_outer("tokens").alias("j", "token"))
    pairs = blocks.join(F.broadcast(sides), "token", "left")
    shared = F.array_intersect("t_tokens", "tokens")
    could = (F.size("tokens") >= F.col("need")) & (
        F.least(F.size("t_tokens") - F.col("i"), F.size("tokens") - F.col("j")) >= F.col("need")
    )
    pairs = pairs.withColumn("shared", F.when(could, shared))
    holds = (F.size("shared") >= F.col("need")) & (F.get("shared", F.lit(0)) == F.col("token"))
    pairs = pairs.withColumn("match", F.when(holds, F.col("template")))
    places, name, base = F.lit(None).cast("array<int>"), F.lit(None).cast("string"), F.lit(False)
    for number, (t, _) in enumerate(ranked):
        here = F.col("match") == number
        name = F.when(here, F.lit(t.label)).otherwise(name)
        if t.phrase:
            base = base | here
            places = F.when(here, _consecutive(F.col("words"), t.words.split())).otherwise(places)
    pairs = pairs.select(
        "_row", "doc_id", "n_words", "base", "match", name.alias("name"), F.coalesce(base, F.lit(False)).alias("phrase"),
        (F.size("shared") / F.size("t_tokens")).alias("share"), places.alias("places"),
    )
    shown = F.when(F.col("match").isNotNull() & (~F.col("phrase") | (F.size("places") > 0)), F.col("name"))
    out = pairs.groupBy("_row").agg(
        F.first("doc_id").alias("doc_id"),
        F.first("n_words").cast("long").alias("n_words"),
        F.coalesce(F.sum(F.size("places")), F.lit(0)).cast("long").alias("n_base"),
        F.min(F.col("base") + F.get("places", F.lit(0))).cast("long").alias("first_word"),
        F.max(F.col("base") + F.element_at(F.when(F.size("places") > 0, F.col("places")), -1)).cast("long").alias("last_word"),
        F.collect_set(F.when(F.col("phrase"), shown)).alias("base_labels"),
        F.collect_set(shown).alias("labels"),
        F.coalesce(F.max(F.when(shown.isNotNull(), F.col("share"))), F.lit(0.0)).alias("score"),
    )
    joined = {c: F.array_join(F.sort_array(c), ",") for c in ("base_labels", "labels")}
    return out.withColumns(joined).drop("_row")
