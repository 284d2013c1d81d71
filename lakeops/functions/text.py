"""String expressions: cleaning, matching, rendering (all plain ``Column`` trees)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The four HTML entities that titles may carry.
ENTITIES = {"&nbsp;": " ", "&amp;": "&", "&lt;": "<", "&gt;": ">"}


def strip_markup(col: Column) -> Column:
    """Drop doctype, scripts, styles and tags, then decode the four entities."""
    # The cleaning patterns and their order, here and in clean_title.
    out = F.regexp_replace(col, r"(?i)<!DOCTYPE[^>]*>", "")
    for tag in ("script", "style"):
        out = F.regexp_replace(out, rf"(?i)<{tag}[^>]*>.*?</{tag}>", "")
    out = F.regexp_replace(out, r"<[^>]+>", "")
    for entity, char in ENTITIES.items():
        out = F.regexp_replace(out, f"(?i){entity}", char)
    return out


def clean_title(col: Column, words: int = 5) -> Column:
    """First ``words`` words of the text with markup and punctuation removed."""
    unmarked = F.regexp_replace(strip_markup(col), r"""[*_"'`]""", "")
    plain = F.regexp_replace(unmarked, r"[^A-Za-z0-9_\s]", "")
    squeezed = F.trim(F.regexp_replace(plain, r"\s+", " "))
    return F.array_join(F.slice(F.split(squeezed, " "), 1, words), " ")


def contains_ci(col: Column, text: Column) -> Column:
    """Case-insensitive containment."""
    return F.contains(F.upper(col), F.upper(F.trim(text)))


def text_or(col: Column, missing: str = "unknown") -> Column:
    """Value as text, or a placeholder when it is null."""
    return F.coalesce(col.cast("string"), F.lit(missing))


def cut(col: Column, length: int) -> Column:
    """First ``length`` characters."""
    return F.substring(col, 1, length)


def template(parts: Sequence[str | Column], null_as: str | None = None) -> Column:
    """Concatenate literals and columns.

    With ``null_as=None`` one null part makes the whole text null, as SQL
    ``concat`` does; otherwise nulls render as ``null_as``.
    """
    cols = [F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts]
    if null_as is not None:
        cols = [F.coalesce(c, F.lit(null_as)) for c in cols]
    return F.concat(*cols)


def clause(cond: Column, parts: Sequence[str | Column], otherwise: str = "") -> Column:
    """A sentence part that appears only when ``cond`` holds."""
    return F.when(cond, template(parts)).otherwise(F.lit(otherwise))
