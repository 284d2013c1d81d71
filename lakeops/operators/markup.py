"""Field extraction from pages and news feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.operators.joins import explode_join
from lakeops.operators.project import where_complete
from lakeops.sources.files import flatten_struct


def extract_fields(
    pages: DataFrame,
    html: str,
    container: str,
    rules: dict[str, str],
    keep: tuple[str, ...] = (),
    required: bool = True,
) -> DataFrame:
    """One row per container on a page, with one trimmed field per rule.

    ``container`` and the rules are regular expressions; group 1 is the content.
    Blank fields are null and, with ``required``, such rows are left out.
    """
    found = pages.select(*keep, F.posexplode(F.regexp_extract_all(html, F.lit(container), 1)).alias("_i", "_c"))
    fields = {
        name: F.nullif(F.trim(F.regexp_extract("_c", rule, 1)), F.lit("")) for name, rule in rules.items()
    }
    out = found.select(*keep, F.col("_i").alias("item"), *[c.alias(n) for n, c in fields.items()])
    return where_complete(out, list(rules)) if required else out


def flatten_news(df: DataFrame, nested: str = "ticker_sentiment", drop: tuple[str, ...] = ()) -> DataFrame:
    """Feed articles with one row per ticker entry and no nested columns left."""
    return flatten_struct(explode_join(df, nested).drop(*drop), "_")
