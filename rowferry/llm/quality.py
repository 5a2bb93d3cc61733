"""Operator 5: quality by weak supervision. Rules vote or abstain; expectation-maximisation learns how far to trust each.

Built-in expressions only. The driver sees one row per pattern of votes, of which there are at most 3 ** rules.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import any_names, without

SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
REPEAT_PERCENT = 20


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row, also where body uses it inside a lambda."""
    return F.transform(F.array(value), body)[0]


def _repeated(words: Column) -> Column:
    """Words that lie in a run of five words found twice or more in the text.

    The runs are compared as strings. Most texts repeat none, which the number of distinct hashes shows cheaply;
    equal hashes only lead to the comparison and decide nothing.
    """
    n = F.size(words)

    def covered(starts: Column) -> Column:
        steps = F.transform(
            starts, lambda at, i: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, i + 1) - at, F.lit(WINDOW)))
        )
        return F.aggregate(steps, F.lit(0), lambda a, b: a + b)

    def exact(all_words: Column, starts: Column) -> Column:
        runs = F.transform(
            starts, lambda i: F.struct(F.array_join(F.slice(all_words, i + 1, WINDOW), " ").alias("run"), i.alias("at"))
        )
        return _let(
            F.sort_array(runs),
            lambda s: _let(
                F.sort_array(
                    F.filter(
                        F.transform(
                            s,
                            lambda x, i: F.when(
                                (F.get(s, i - 1)["run"] == x["run"]) | (F.get(s, i + 1)["run"] == x["run"]), x["at"]
                            ),
                        ),
                        lambda at: at.isNotNull(),
                    )
                ),
                covered,
            ),
        )

    def suspects(all_words: Column) -> Column:
        """Starts whose hash occurs twice or more."""
        hashes = F.transform(
            F.sequence(F.lit(0), F.size(all_words) - WINDOW),
            lambda i: F.xxhash64(*[F.get(all_words, i + j) for j in range(WINDOW)]),
        )
        return _let(
            hashes,
            lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(
                exact(all_words, F.sequence(F.lit(0), F.size(all_words) - WINDOW))
            ),
        )

    return F.when(n < WINDOW + 1, F.lit(0)).otherwise(_let(words, suspects))


def _count(text: Column, characters: str) -> Column:
    """Occurrences of single ASCII characters; plain byte searches are far cheaper here than translate or patterns."""
    counts = [F.octet_length(text) - F.octet_length(F.replace(text, F.lit(c), F.lit(""))) for c in characters]
    return sum(counts[1:], counts[0])


def _words(text: Column) -> Column:
    """The words between ASCII white space."""
    for c in SPACE[1:]:
        text = F.replace(text, F.lit(c), F.lit(" "))
    return F.array_remove(F.split(text, " ", -1), "")


@any_names
def features(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Add the measures that the rules look at, all long: those of the contract and ``n_upper`` (A-Z),
    ``n_ends`` (of ``.!?``) and ``n_distinct`` (words). NULL text has none of anything; so has an empty one."""
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_ends", "n_distinct", "_text", "_words")
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = without(docs, *names)
    own = [F.col(f"`{c.replace('`', '``')}`") for c in rows.columns]
    rows = rows.select(*own, text.alias("_text"))
    rows = rows.select(*own, "_text", _words(F.col("_text")).alias("_words"))
    lines = F.filter(F.split("_text", "\n", -1), lambda x: F.trim(x, F.lit(SPACE)) != F.lit(""))
    solid = F.col("_text")
    for c in SPACE:
        solid = F.replace(solid, F.lit(c), F.lit(""))
    measures = {
        "n_words": F.size("_words"),
        "word_chars": F.length(solid),
        "n_symbols": _count(F.col("_text"), SYMBOLS),
        "n_dup_lines": _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))),
        "n_repeat_words": _repeated(F.col("_words")),
        "n_upper": F.octet_length(F.regexp_replace("_text", "[^A-Z]+", "")),
        "n_ends": _count(F.col("_text"), ".!?"),
        "n_distinct": F.size(F.array_distinct("_words")),
    }
    # Through a generator, so that a filter on a measure is not moved below it, which would compute all of them again.
    return rows.select(*own, F.inline(F.array(F.struct(*[c.cast("long").alias(n) for n, c in measures.items()]))))


@dataclass(frozen=True)
class Rule:
    """A labelling function: 1 for good, -1 for bad, 0 to abstain."""

    name: str
    vote: Column


def _vote(bad: Column, good: Column) -> Column:
    return F.when(bad, F.lit(-1)).when(good, F.lit(1)).otherwise(F.lit(0))


def rules() -> list[Rule]:
    """Eight rules on the measures, two or more on each kind of fault: EM can only tell a fault from chance where rules
    agree on it. Each abstains between its two thresholds; all abstain where there are no words.

    Variety compares the distinct words with the root of all words, since long texts repeat words more than short ones.
    """
    n, chars = F.col("n_words"), F.col("word_chars")
    distinct = F.col("n_distinct") * F.col("n_distinct")
    made = [
        ("word_length", _vote((chars > 14 * n) | (chars < 2 * n), (chars <= 11 * n) & (chars >= 3 * n))),
        ("symbols", _vote(F.col("n_symbols") * 10 > n, F.col("n_symbols") * 50 < n)),
        ("symbol_share", _vote(F.col("n_symbols") * 25 > chars, F.col("n_symbols") * 100 < chars)),
        ("capitals", _vote(F.col("n_upper") * 2 > chars, F.col("n_upper") * 5 < chars)),
        ("repeats", _vote(F.col("n_repeat_words") * 5 > n, F.col("n_repeat_words") * 20 < n)),
        ("variety", _vote((n >= 20) & (distinct < 4 * n), (n < 20) | (distinct > 8 * n))),
        ("sentences", _vote((n >= 40) & (F.col("n_ends") * 80 < n), F.col("n_ends") * 40 >= n)),
        ("shouting", _vote(F.col("n_ends") * 2 > n + 4, F.col("n_ends") * 3 <= n + 4)),
    ]
    return [Rule(name, F.when(n == 0, F.lit(0)).otherwise(vote)) for name, vote in made]


@dataclass(frozen=True)
class VoteModel:
    """What EM learnt: shares of the hidden classes and, per class and rule, the chances of its votes."""

    shares: list[float]
    votes: list[list[dict[int, float]]]

    def posterior(self, pattern: tuple[int, ...]) -> float:
        """The chance that a text with these votes is of the good class."""
        logs = [
            math.log(share) + sum(math.log(table[v]) for table, v in zip(tables, pattern))
            for share, tables in zip(self.shares, self.votes)
        ]
        top = max(logs)
        each = [math.exp(x - top) for x in logs]
        return each[0] / sum(each)


def fit_votes(patterns: list[tuple[tuple[int, ...], int]], rounds: int = 200) -> VoteModel:
    """Expectation-maximisation over vote patterns and their counts.

    The hidden class is good, or bad in the way that one of the rules is about: bad texts break different rules, so a
    single bad class would not have independent votes. Given the class, rules vote independently. At the start a
    rule is right nine times out of ten on its own kind and on good texts; EM then estimates how accurate it is. One
    smoothing count per vote keeps chances off 0 and 1.
    """
    n_rules = len(patterns[0][0]) if patterns else 0
    kinds, values = n_rules + 1, (-1, 0, 1)
    fine, off, own = {-1: 0.02, 0: 0.08, 1: 0.9}, {-1: 0.15, 0: 0.1, 1: 0.75}, {-1: 0.9, 0: 0.05, 1: 0.05}
    tables = [[dict(fine if k == 0 else own if k == r + 1 else off) for r in range(n_rules)] for k in range(kinds)]
    model = VoteModel([0.9] + [0.1 / max(1, n_rules)] * n_rules, tables)
    total = sum(c for _, c in patterns)
    for _ in range(rounds if total else 0):
        seen = [[dict.fromkeys(values, 1.0) for _ in range(n_rules)] for _ in range(kinds)]
        sizes = [1.0] * kinds
        for pattern, count in patterns:
            logs = [math.log(model.shares[k]) + sum(math.log(model.votes[k][r][v]) for r, v in enumerate(pattern)) for k in range(kinds)]
            top = max(logs)
            each = [math.exp(x - top) for x in logs]
            for k in range(kinds):
                part = count * each[k] / sum(each)
                sizes[k] += part
                for r, v in enumerate(pattern):
                    seen[k][r][v] += part
        shares = [x / sum(sizes) for x in sizes]
        votes = [[{v: x / sum(t.values()) for v, x in t.items()} for t in tables] for tables in seen]
        done = max(abs(a - b) for a, b in zip(shares, model.shares)) < 1e-9
        model = VoteModel(shares, votes)
        if done:
            break
    return model


def vote_patterns(measured: DataFrame, used: list[Rule]) -> list[tuple[tuple[int, ...], int]]:
    """How often each pattern of votes occurs, over all rows; at most 3 ** rules patterns."""
    rows = measured.groupBy(*[r.vote.alias(f"v{i}") for i, r in enumerate(used)]).count().collect()
    return sorted((tuple(row[: len(used)]), row["count"]) for row in rows)


def judge(measured: DataFrame, model: VoteModel, used: list[Rule], least: float = 0.5) -> DataFrame:
    """Add ``posterior``, ``base_failed`` and ``kept`` to measured rows.

    The posteriors of all possible patterns are a constant array, looked up by the pattern's number.
    """
    each = [model.posterior(p) for p in itertools.product((-1, 0, 1), repeat=len(used))]
    number = F.lit(0)
    for rule in used:
        number = number * 3 + rule.vote + 1
    posterior = F.get(F.split(F.lit(",".join(map(repr, each))), ",", -1).cast("array<double>"), number)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    rows = without(measured, "posterior", "base_failed", "kept").withColumns({"posterior": posterior, "base_failed": failed})
    return rows.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= F.lit(least)))


@any_names
def rate_quality(docs: DataFrame, least: float = 0.5, text_col: str = "text", measured: DataFrame | None = None) -> DataFrame:
    """``docs`` with their measures, ``posterior``, ``base_failed`` and ``kept``.

    Patterns are counted over all rows, so the model is that of the whole table; with equal rows it is the same
    whatever the partitions. ``measured`` may pass the measures already written, which saves computing them again;
    otherwise they are computed twice, once for the counts and once for the result, which needs no copy of the texts.
    NULL, empty and short texts fail the base rule; repeated rows are judged alike; columns with the names of the
    added ones are replaced. An empty table gives no rows.
    """
    used = rules()
    measured = features(docs, text_col) if measured is None else measured
    return judge(measured, fit_votes(vote_patterns(measured, used)), used, least)
