"""Conditional expressions: buckets, flags, validity, literal lookups."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F


def bucketize(col: Column, edges: Sequence[float], labels: Sequence[str], null_label: str) -> Column:
    """Label by strict upper edges; the last label has no upper edge."""
    if len(labels) != len(edges) + 1:
        raise ValueError("one label more than edges is needed")
    out = F.when(col.isNull(), F.lit(null_label))
    for edge, label in zip(edges, labels):
        out = out.when(col < F.lit(edge), F.lit(label))
    return out.otherwise(F.lit(labels[-1]))


def validity_status(start: Column, end: Column, as_of: Column) -> Column:
    """ACTIVE on every day from start to end, both included, else EXPIRED."""
    return F.when(as_of.between(start, end), F.lit("ACTIVE")).otherwise(F.lit("EXPIRED"))


def flag_above(col: Column, limit: float, hi: str, lo: str) -> Column:
    return F.when(col > F.lit(limit), F.lit(hi)).otherwise(F.lit(lo))


def indicator(cond: Column) -> Column:
    """1 where the condition holds, else 0."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def lookup(col: Column, table: dict, default=None) -> Column:
    """Value from a small literal map."""
    pairs = F.create_map(*[F.lit(x) for x in chain.from_iterable(table.items())])
    found = F.try_element_at(pairs, col)
    return found if default is None else F.coalesce(found, F.lit(default))


def clamp(col: Column, lo: float, hi: float) -> Column:
    return F.least(F.greatest(col, F.lit(lo)), F.lit(hi))
