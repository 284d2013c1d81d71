"""Quality rules as a short-circuit cascade.

A rule says where a text must go.  ``plan_cascade`` measures on a sample how
often each rule rejects and what it costs, and orders the rules by rejections
per cost.  ``first_rejection`` turns the order into one ``CASE`` expression: a
row that one rule rejects never evaluates the next.  The order changes only the
work and the name of the first rejecting rule, never which rows are kept.

Rules read ``Measures``.  Over a bare text every measure is an expression that
runs when a rule first asks for it; where a report has the measures as columns
anyway, the rules read those.

Defined results: a null or empty text has no words and is rejected; ties in
rank keep the rules' given order; an empty table keeps the given order; repeated
rows are judged alike; other columns are passed on untouched.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.llm.exprs import NOT_SPACE, let, words
from lakeops.session import materialise

SYMBOLS = "#*$%&|<>"
PLACE_BITS = 24
EXACT = (1 << PLACE_BITS) - 1


def _word_lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n", -1), lambda line: line.rlike(NOT_SPACE))


def _repeats(lines: Column) -> Column:
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint")


def _window(w: Column, i: Column) -> Column:
    return F.concat_ws(" ", w[i], w[i + 1], w[i + 2])


def _span_words(places: Column) -> Column:
    """Words under the three-word windows at the sorted places."""
    new = F.transform(places, lambda p, i: F.when(i > 0, F.least(p - places[i - 1], F.lit(3))).otherwise(F.lit(3)))
    return F.aggregate(new, F.lit(0).cast("bigint"), lambda a, b: a + b)


def _repeat_by_text(w: Column) -> Column:
    """Exact count by sorting the windows themselves with their places."""
    grams = F.transform(
        F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.struct(_window(w, i).alias("w"), i.alias("i"))
    )

    def count(ordered: Column) -> Column:
        pairs = F.filter(
            F.sequence(F.lit(1), F.size(ordered) - 1), lambda i: ordered[i - 1]["w"] == ordered[i]["w"]
        )
        return _under_pairs(pairs, lambda i: ordered[i]["i"])

    return let(F.sort_array(grams), count)


def _under_pairs(pairs: Column, place: Callable[[Column], Column]) -> Column:
    """Words under the windows that are equal neighbours in a sorted array, given by the later's index."""
    both = F.flatten(F.transform(pairs, lambda i: F.array(place(i - 1), place(i))))
    return let(F.sort_array(F.array_distinct(both)), _span_words)


def repeat_words(w: Column) -> Column:
    """Words inside three-word windows that occur twice or more, the first place included.

    A window becomes one long, hash above place, so that sorting longs brings equal
    windows together.  Neighbours with one hash are compared as text; should two
    different windows share a hash, or the places not fit, the windows themselves are sorted.
    """

    def count(ordered: Column) -> Column:
        def place(i: Column) -> Column:
            return ordered[i].bitwiseAND(F.lit(EXACT)).cast("int")

        def settle(pairs: Column) -> Column:
            clash = F.exists(pairs, lambda i: _window(w, place(i - 1)) != _window(w, place(i)))
            return (
                F.when(F.size(pairs) == 0, F.lit(0).cast("bigint"))
                .when(clash, _repeat_by_text(w))
                .otherwise(_under_pairs(pairs, place))
            )

        # equal hashes differ in the place bits alone
        pairs = F.filter(
            F.sequence(F.lit(1), F.size(ordered) - 1),
            lambda i: F.shiftright(ordered[i - 1].bitwiseXOR(ordered[i]), PLACE_BITS) == 0,
        )
        return let(pairs, settle)

    packed = F.transform(
        F.sequence(F.lit(0), F.size(w) - 3),
        lambda i: F.shiftleft(F.xxhash64(w[i], w[i + 1], w[i + 2]), PLACE_BITS).bitwiseOR(i.cast("bigint")),
    )
    return (
        F.when(F.size(w) < 4, F.lit(0).cast("bigint"))
        .when(F.size(w) > EXACT, _repeat_by_text(w))
        .otherwise(let(F.sort_array(packed), count))
    )


@dataclass(frozen=True)
class Measures:
    """What rules may read of one text; each a column."""

    n_words: Column
    word_chars: Column
    n_symbols: Column
    n_dup_lines: Column
    n_repeat_words: Column
    n_lines: Column
    n_capitals: Column


def measures(text: Column, split: Column | None = None) -> Measures:
    """Every measure as an expression of its own over a text (null: empty); ``split`` are its words."""
    t = F.coalesce(text, F.lit(""))
    w = words(t) if split is None else split
    return Measures(
        n_words=F.size(w).cast("bigint"),
        word_chars=F.length(F.concat_ws("", w)).cast("bigint"),
        n_symbols=F.length(F.regexp_replace(t, f"[^{SYMBOLS}]+", "")).cast("bigint"),
        n_dup_lines=let(_word_lines(t), _repeats),
        n_repeat_words=let(words(t), repeat_words) if split is None else repeat_words(w),
        n_lines=F.size(_word_lines(t)).cast("bigint"),
        n_capitals=(F.length(t) - F.length(F.regexp_replace(t, "[A-Z]+", ""))).cast("bigint"),
    )


@dataclass(frozen=True)
class Rule:
    """``reject`` is true where the text must go."""

    name: str
    reject: Callable[[Measures], Column]


def too_few_words(least: int = 50) -> Rule:
    return Rule("too_few_words", lambda m: m.n_words < least)


def repeated_words(percent: int = 50) -> Rule:
    return Rule("repeated_words", lambda m: 100 * m.n_repeat_words > percent * m.n_words)


def many_symbols(percent: int = 10) -> Rule:
    return Rule("many_symbols", lambda m: 100 * m.n_symbols > percent * m.n_words)


def word_length(low: int = 3, high: int = 10) -> Rule:
    """Mean word length outside ``low`` to ``high``."""
    return Rule("word_length", lambda m: ~m.word_chars.between(low * m.n_words, high * m.n_words))


def repeated_lines(percent: int = 40) -> Rule:
    return Rule("repeated_lines", lambda m: 100 * m.n_dup_lines > percent * m.n_lines)


def shouting(percent: int = 30) -> Rule:
    """Letters A-Z against all characters of words."""
    return Rule("shouting", lambda m: 100 * m.n_capitals > percent * m.word_chars)


BASE = (too_few_words(), repeated_words())
#: Production rules; the limits follow common web-text filters.
RULES = (*BASE, many_symbols(), word_length(), repeated_lines(), shouting())


@dataclass(frozen=True)
class Measured:
    rule: Rule
    rejected: float
    seconds: float

    @property
    def rank(self) -> float:
        return self.rejected / max(self.seconds, 1e-3)


def plan_cascade(
    docs: DataFrame, rules: Sequence[Rule] = RULES, text_col: str = "text", sample_rows: int = 1000
) -> list[Measured]:
    """Rules ordered by rejections per cost, as measured on at most ``sample_rows`` rows.

    Only the order depends on the sample.  It is taken from as few partitions as hold
    it and written once; each rule's cost is the time of an aggregate over it beyond
    that of the bare scan.
    """
    rows = docs.select(F.col(text_col).alias("text")).head(sample_rows)
    sample = materialise(docs.sparkSession.createDataFrame(rows, "text string"), "quality-sample")
    of = measures(F.col("text"))

    def timed(column: Column) -> tuple[int, int, float]:
        best, got = float("inf"), None
        for _ in range(2):  # the first run also compiles
            start = time.perf_counter()
            got = sample.agg(F.count(F.lit(1)), F.count_if(column)).first()
            best = min(best, time.perf_counter() - start)
        return got[0], got[1], best

    rows, _, scan = timed(F.length("text") < 0)
    out = []
    for rule in rules:
        _, hit, seconds = timed(rule.reject(of))
        out.append(Measured(rule, hit / rows if rows else 0.0, max(0.0, seconds - scan)))
    return sorted(out, key=lambda m: -m.rank)


def first_rejection(of: Measures, ordered: Sequence[Rule]) -> Column:
    """Name of the first rule in the order that rejects, else null."""
    column = F
    for rule in ordered:
        column = column.when(rule.reject(of), F.lit(rule.name))
    return column.otherwise(F.lit(None).cast("string"))


def quality_filter(
    docs: DataFrame, rules: Sequence[Rule] = RULES, text_col: str = "text", sample_rows: int = 1000
) -> DataFrame:
    """The rows that no rule rejects, with their columns as they are.  A text is split into words once."""
    ordered = [m.rule for m in plan_cascade(docs, rules, text_col, sample_rows)]
    text = docs[text_col]
    return docs.where(let(words(text), lambda w: first_rejection(measures(text, w), ordered)).isNull())


def quality_report(
    docs: DataFrame,
    rules: Sequence[Rule] = RULES,
    id_col: str = "doc_id",
    text_col: str = "text",
    sample_rows: int = 1000,
) -> DataFrame:
    """Measures of every text, the base verdict and the cascade's verdict.

    ``kept`` is false where a base rule or any rule of the cascade rejects.
    """
    ordered = [m.rule for m in plan_cascade(docs, rules, text_col, sample_rows)]
    bare = measures(F.col(text_col))

    def of_words(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("bigint").alias("n_words"),
            F.length(F.concat_ws("", w)).cast("bigint").alias("word_chars"),
            repeat_words(w).alias("n_repeat_words"),
        )

    measured = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(text_col).alias("text"),
        let(words(F.col(text_col)), of_words).alias("by_word"),
        bare.n_symbols.alias("n_symbols"),
        bare.n_dup_lines.alias("n_dup_lines"),
    ).select("doc_id", "text", "by_word.*", "n_symbols", "n_dup_lines")
    lazily = measures(F.col("text"))
    ready = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    of = Measures(n_lines=lazily.n_lines, n_capitals=lazily.n_capitals, **{name: F.col(name) for name in ready})
    failed = first_rejection(of, BASE).isNotNull()
    return measured.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & first_rejection(of, ordered).isNull()).alias("kept"),
    )
