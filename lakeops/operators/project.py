"""Projections, filters and predicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.functions.text import contains_ci
from lakeops.operators.ordered import row_numbers


def project(df: DataFrame, cols: Sequence[str] | dict[str, str]) -> DataFrame:
    """Columns by name, or ``{source: alias}``."""
    if isinstance(cols, dict):
        return df.select(*[F.col(c).alias(a) for c, a in cols.items()])
    return df.select(*cols)


def rename_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(mapping)


def drop_columns(df: DataFrame, *cols: str) -> DataFrame:
    return df.drop(*cols)


def add_audit(
    df: DataFrame, data_source: str, file_date: str, env: str | None = None, now: Column | None = None
) -> DataFrame:
    """Source, file date, (environment) and ingestion time of every row."""
    extra = {"data_source": F.lit(data_source), "file_date": F.lit(file_date)}
    if env is not None:
        extra["env"] = F.lit(env)
    extra["ingestion_date"] = F.current_timestamp() if now is None else now
    return df.withColumns(extra)


def expand_struct(df: DataFrame, col: str) -> DataFrame:
    """Fields of a struct column in its place."""
    return df.select(*[f"{c}.*" if c == col else c for c in df.columns])


def reorder(df: DataFrame, first: Sequence[str] = (), last: Sequence[str] = ()) -> DataFrame:
    middle = [c for c in df.columns if c not in (*first, *last)]
    return df.select(*first, *middle, *last)


_COMPARE = {
    "=": lambda a, b: a == b,
    "<>": lambda a, b: a != b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
}


def where_cmp(df: DataFrame, col: str, op: str, value) -> DataFrame:
    return df.filter(_COMPARE[op](F.col(col), F.lit(value)))


def where_between(df: DataFrame, col: str, lo, hi) -> DataFrame:
    """Both ends included."""
    return df.filter(F.col(col).between(lo, hi))


def where_present(df: DataFrame, *cols: str) -> DataFrame:
    """Neither null nor an empty string."""
    for c in cols:
        df = df.filter(F.col(c).isNotNull() & (F.col(c) != ""))
    return df


def where_min_length(df: DataFrame, col: str, more_than: int = 10) -> DataFrame:
    return df.filter(F.col(col).isNotNull() & (F.length(col) > more_than))


def where_optional(df: DataFrame, col: str, value=None) -> DataFrame:
    """Equality filter that is skipped when no value is given."""
    return df if value is None else df.filter(F.col(col) == F.lit(value))


def where_contains(df: DataFrame, col: str, text: str) -> DataFrame:
    return df.filter(F.contains(F.col(col), F.lit(text)))


def where_complete(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.dropna(how="any", subset=list(cols))


def resolve_name(df: DataFrame, col: str, text: str, lookup: DataFrame) -> DataFrame:
    """Rows whose name matches a short form or contains the text.

    ``lookup`` has columns ``short`` and ``full``.  When the text is a known short
    form the full name must match, otherwise names containing the text do; case
    does not matter.  The full name is read as a scalar subquery.
    """
    full = lookup.filter(F.upper("short") == F.upper(F.trim(F.lit(text)))).agg(F.max("full")).scalar()
    return df.filter(contains_ci(F.col(col), F.coalesce(full, F.lit(text))))


def flatten_record(df: DataFrame, mapping: dict[str, Column | str]) -> DataFrame:
    """Flat columns from nested fields: output name to dotted path or expression."""
    return df.select(*[(F.col(v) if isinstance(v, str) else v).alias(k) for k, v in mapping.items()])


def with_surrogate_key(
    df: DataFrame, order: Sequence[str], out: str = "id", chunk: Column | str | None = None
) -> DataFrame:
    """Gap-free ids from 1 along a total order, numbered range by range."""
    return row_numbers(df, None, order, out, chunk)
