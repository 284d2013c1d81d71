"""JSON payload expressions: repair, extraction, safe casts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def repair_quotes(col: Column) -> Column:
    """Put the missing comma between two adjacent string pairs (``""`` to ``","``)."""
    return F.replace(col, F.lit('""'), F.lit('","'))


def rebuild_object(col: Column) -> Column:
    """Rebuild one object from pairs on separate lines inside a one-character frame."""
    body = F.trim(col)
    inner = F.substr(body, F.lit(2), F.length(body) - 2)
    return F.concat(F.lit("{"), F.replace(inner, F.lit("\n"), F.lit(",")), F.lit("}"))


def field(col: Column, name: str) -> Column:
    """Text of one top-level field, null when absent."""
    return F.get_json_object(col, f"$.{name}")


def int_field(col: Column, name: str) -> Column:
    """Integer field, 0 when missing or not a number."""
    return F.coalesce(field(col, name).try_cast("bigint"), F.lit(0).cast("bigint"))


def blank_to_null(col: Column) -> Column:
    return F.nullif(col, F.lit(""))


def safe_number(col: Column, kind: str = "double") -> Column:
    """Number or null; blank and malformed text become null."""
    return F.trim(col).try_cast(kind)


def safe_unsigned(col: Column, bits: int = 32) -> Column:
    """Unsigned integer of ``bits`` bits, null when out of range."""
    value = F.trim(col).try_cast("decimal(20,0)")
    return F.when(value.between(0, 2**bits - 1), value.cast("bigint"))


def parse(col: Column, schema: StructType | str) -> Column:
    return F.from_json(col, schema)


def from_base64(col: Column) -> Column:
    """UTF-8 text from base64; malformed input gives null."""
    return F.try_to_binary(col, F.lit("base64")).cast("string")
