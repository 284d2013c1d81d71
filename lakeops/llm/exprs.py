"""Column helpers shared by the operators that use built-in functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"[ \t-\r]"
NOT_SPACE = r"[^ \t-\r]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use the result in ``body``.

    A lambda parameter holds an evaluated value, so an expensive expression that
    ``body`` names several times, or inside another lambda, is not evaluated again.
    """
    return F.transform(F.array(value), lambda v: body(v))[0]


def words(text: Column) -> Column:
    """Array of the words ``[^ \\t-\\r]+`` of a text; empty for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), "")


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(NOT_SPACE + "+")), F.lit(0)).cast("bigint")


def _folded(values: Column, combine: Callable[[Column, Column], Column], kind: str) -> Column:
    return F.aggregate(
        values,
        F.array().cast(kind),
        lambda done, x: F.array_append(
            done, F.when(F.size(done) > 0, combine(F.element_at(done, -1), x)).otherwise(x)
        ),
    )


def running(
    values: Column, combine: Callable[[Column, Column], Column], kind: str = "array<int>", block: int = 64
) -> Column:
    """Running fold of an array.

    A growing accumulator copies itself at each step, so an array longer than
    ``block`` is folded in blocks of about the square root of its length, and the
    folded ends of the blocks are carried over.
    """

    def blockwise(v: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(v))).cast("int")

        def carry(blocks: Column) -> Column:
            ends = _folded(F.transform(blocks, lambda b: F.element_at(b, -1)), combine, kind)
            return let(
                ends,
                lambda done: F.flatten(
                    F.transform(
                        blocks,
                        lambda b, j: F.when(j > 0, F.transform(b, lambda x: combine(done[j - 1], x))).otherwise(b),
                    )
                ),
            )

        starts = F.sequence(F.lit(1), F.size(v), width)
        return let(F.transform(starts, lambda at: _folded(F.slice(v, at, width), combine, kind)), carry)

    return let(values, lambda v: F.when(F.size(v) > block, blockwise(v)).otherwise(_folded(v, combine, kind)))


SPAN = "array<struct<s:int,e:int,m:string>>"


def spans(text: Column, pattern: str) -> Column:
    """Leftmost matches of ``pattern`` that do not overlap, as ``(s, e, m)`` in code points.

    The engine's functions give the matched strings and the gaps between them; the
    running sum of both lengths is the position.
    """

    def place(found: Column) -> Column:
        def with_gaps(gaps: Column) -> Column:
            steps = F.transform(
                found,
                lambda m, i: F.length(gaps[i]) + F.when(i > 0, F.length(found[i - 1])).otherwise(F.lit(0)),
            )
            return let(
                running(steps, lambda a, b: a + b),
                lambda at: F.transform(
                    found, lambda m, i: F.struct(at[i].alias("s"), (at[i] + F.length(m)).alias("e"), m.alias("m"))
                ),
            )

        return F.when(F.size(found) > 0, let(F.split(text, pattern, -1), with_gaps)).otherwise(
            F.array().cast(SPAN)
        )

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), place)
