"""Message payloads: tolerant parse, base64, nested envelopes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.functions import payload

CORRUPT = "_corrupt"
_KEEP_CORRUPT = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}


def _schema(schema: T.StructType | str) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)


def parse_json_tolerant(
    df: DataFrame, col: str, schema: T.StructType | str
) -> tuple[DataFrame, DataFrame]:
    """Typed rows, and the rows whose text could not be parsed (nothing raises)."""
    wanted = _schema(schema)
    probe = T.StructType([*wanted.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = df.withColumn("_p", F.from_json(F.col(col), probe, _KEEP_CORRUPT))
    broken = F.col("_p").isNull() | F.col(f"_p.{CORRUPT}").isNotNull()
    rest = [c for c in df.columns if c != col]
    good = parsed.filter(~broken).select(*rest, *[F.col(f"_p.`{f.name}`") for f in wanted.fields])
    bad = parsed.filter(broken).select(*df.columns)
    return good, bad


def decode_base64_json(df: DataFrame, col: str, schema: T.StructType | str) -> DataFrame:
    """Columns of a base64-encoded JSON payload next to the other columns."""
    decoded = df.withColumn("_p", F.from_json(payload.from_base64(F.col(col)), _schema(schema)))
    return decoded.select(*[c for c in df.columns if c != col], "_p.*")


def unwrap_envelope(df: DataFrame, body: str = "body", out: str = "detail") -> DataFrame:
    """Business object inside a queue record, as JSON text; unusable records drop out.

    A ``Message`` field holds another JSON text whose ``detail`` is taken, else a
    ``detail`` field is taken, else the body is the object itself.  Blank text,
    text that is not a JSON object and an empty detail are dropped.
    """
    fields = F.from_json(F.col(body), f"Message STRING, detail STRING, {CORRUPT} STRING", _KEEP_CORRUPT)
    parsed = df.withColumns({"_f": fields, "_keys": F.json_object_keys(body)})
    # exactly one value: text after a complete object makes the record unusable
    alone = F.json_array_length(F.concat(F.lit("["), F.col(body), F.lit("]"))) == 1
    parsed = parsed.filter(F.col("_keys").isNotNull() & F.col(f"_f.{CORRUPT}").isNull() & alone)
    inner = F.from_json("_f.Message", f"detail STRING, {CORRUPT} STRING", _KEEP_CORRUPT)
    detail = (
        F.when(F.array_contains("_keys", "Message"), F.when(inner[CORRUPT].isNull(), inner["detail"]))
        .when(F.array_contains("_keys", "detail"), F.col("_f.detail"))
        .otherwise(F.col(body))
    )
    # JSON renderings that count as an empty detail.
    empty = ["", "{}", "[]", "0", "0.0", "false", "null"]
    # the lambda binds the value once; a filter would compute it again per test
    usable = F.filter(F.array(detail), lambda v: v.isNotNull() & ~v.isin(empty))
    return parsed.withColumn(out, F.explode(usable)).drop("_f", "_keys")
