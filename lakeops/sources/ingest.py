"""Incremental ingest of files whose columns come, go and change their order.

A stream lists the files that arrived; every micro-batch reads its files as text by
the names that each file gives its columns, brings them to the newest tracked schema,
and replaces the target's partition of that batch, so that a replayed batch changes
nothing.  The tracked schema is a log of versions: a column that a file brings for the
first time makes a new version, and rows loaded before have nulls there.  What does
not fit a column's type, and what stands in records that cannot be taken apart, goes
to ``_rescued`` as JSON text by column name; nothing is dropped.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DateType, MapType, StringType, StructField, StructType, TimestampNTZType, TimestampType

RESCUED, BATCH, RECORD = "_rescued", "_batch", "_record"
MAX_FILES = 1000
FILES = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"


class SchemaLog:
    """Versions of a dataset's schema, kept as rows under ``place``."""

    def __init__(self, spark: SparkSession, place: str):
        self.spark, self.place = spark, place

    def versions(self) -> list[StructType]:
        try:
            rows = self.spark.read.schema("version INT, schema STRING").parquet(self.place).collect()  # one row per version
        except AnalysisException:
            return []
        import json

        return [StructType.fromJson(json.loads(r.schema)) for r in sorted(rows, key=lambda r: r.version)]

    def newest(self) -> StructType | None:
        found = self.versions()
        return found[-1] if found else None

    def add(self, schema: StructType) -> StructType:
        row = [(len(self.versions()), schema.json())]
        self.spark.createDataFrame(row, "version INT, schema STRING").coalesce(1).write.mode("append").parquet(self.place)
        return schema


def _options(fmt: str, options: dict) -> dict:
    return {"header": "true", **options} if fmt == "csv" else dict(options)


def _inferred(spark: SparkSession, paths: Sequence[str], fmt: str, options: dict) -> StructType:
    reader = spark.read.options(**_options(fmt, options))
    if fmt in ("csv", "json"):
        reader = reader.option("inferSchema", True)
    elif fmt in ("parquet", "orc"):
        reader = reader.option("mergeSchema", True)
    return reader.format(fmt).load(list(paths)).schema


def tracked_schema(spark: SparkSession, source: str, place: str, fmt: str, **options) -> StructType:
    """The newest version under ``place``; inferred from ``source`` and kept if there is none."""
    log = SchemaLog(spark, place)
    return log.newest() or log.add(_inferred(spark, [source], fmt, options))


def _text_fields(names: Sequence[str]) -> StructType:
    return StructType([StructField(n, StringType()) for n in names])


def _groups(spark: SparkSession, paths: Sequence[str], fmt: str, options: dict) -> dict[str, tuple[StructType, list[str]]]:
    """Files by the columns that each of them has.  A file's own head is read by a job of one task."""

    def own(path: str) -> StructType:
        return spark.read.options(**_options(fmt, options)).format(fmt).load(path).schema

    if fmt == "json":
        names = spark.read.options(**{**options, "primitivesAsString": "true"}).json(list(paths)).columns
        found = [(_text_fields([n for n in names if n != "_corrupt_record"]), p) for p in paths]
    else:
        with ThreadPoolExecutor(16) as pool:
            found = list(zip(pool.map(own, paths), paths))
        if fmt == "csv":
            found = [(_text_fields(schema.names), path) for schema, path in found]
    groups: dict[str, tuple[StructType, list[str]]] = {}
    for schema, path in found:
        if schema.names:
            groups.setdefault(schema.json(), (schema, []))[1].append(path)
    return groups


def _read(spark: SparkSession, source: str, schema: StructType, paths: list[str], fmt: str, options: dict) -> DataFrame:
    """Files of one kind; text formats as text, with a whole bad record in ``_record``."""
    reader = spark.read.options(**_options(fmt, options))
    if not set("*?{[") & set(source):
        reader = reader.option("basePath", source)
    if fmt in ("csv", "json"):
        kept = StructType([*schema.fields, StructField(RECORD, StringType())])
        reader = reader.schema(kept).option("columnNameOfCorruptRecord", RECORD).option("mode", "PERMISSIVE")
    return reader.format(fmt).load(paths)


def _as(text: Column, field: StructField, options: dict) -> Column:
    """Text as a value of the field's type, null where it is none."""
    kind = field.dataType
    if isinstance(kind, (StructType, ArrayType, MapType)):
        opening = "[" if isinstance(kind, ArrayType) else "{"  # anything else would parse to a struct of nulls
        return F.when(F.ltrim(text).startswith(opening), F.from_json(text, kind, options))
    if isinstance(kind, TimestampType) and "timestampFormat" in options:
        return F.try_to_timestamp(text, F.lit(options["timestampFormat"]))
    if isinstance(kind, TimestampNTZType) and "timestampNTZFormat" in options:
        return F.try_to_timestamp(text, F.lit(options["timestampNTZFormat"])).try_cast(kind)
    if isinstance(kind, DateType) and "dateFormat" in options:
        return F.try_to_timestamp(text, F.lit(options["dateFormat"])).try_cast(kind)
    return text.try_cast(kind)


def conform(df: DataFrame, schema: StructType, options: dict | None = None) -> DataFrame:
    """Columns of ``schema`` by name, whatever the case, and ``_rescued`` for what has no place in them."""
    there = {c.lower(): c for c in df.columns}
    kinds = {f.name: f.dataType for f in df.schema.fields}
    wanted, lost = [], []
    for field in schema.fields:
        name = there.pop(field.name.lower(), None)
        if name is None:
            wanted.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        given = F.col(f"`{name}`")
        if kinds[name] == field.dataType:
            wanted.append(given.alias(field.name))
            continue
        text = given if isinstance(kinds[name], StringType) else given.cast("string")
        value = _as(text, field, options or {})
        wanted.append(value.alias(field.name))
        lost += [F.lit(field.name), F.when(value.isNull() & (F.trim(text) != ""), text)]
    for name in there.values():
        kind = kinds[name]
        text = F.to_json(F.col(f"`{name}`")) if isinstance(kind, (StructType, ArrayType, MapType)) else F.col(f"`{name}`").cast("string")
        lost += [F.lit(name), text]
    if not lost:
        return df.select(*wanted, F.lit(None).cast("string").alias(RESCUED))
    found = F.map_filter(F.create_map(*lost), lambda _, v: v.isNotNull())
    return df.select(*wanted, F.when(F.size(found) > 0, F.to_json(found)).alias(RESCUED))


def evolved(old: StructType, groups: Sequence[StructType], found: StructType) -> StructType:
    """``old`` with the columns behind it that files have and it has not, typed as in ``found``."""
    known = {f.name.lower() for f in old.fields}
    kinds = {f.name.lower(): f for f in found.fields}
    fresh = []
    for name in (n for g in groups for n in g.names):
        if name.lower() not in known and name.lower() in kinds:
            known.add(name.lower())
            fresh.append(kinds[name.lower()])
    return StructType([*old.fields, *fresh])


def _store(df: DataFrame, target: str) -> None:
    """Replace the batch's partition; columns that the table has not yet are added to it."""
    from lakeops.sinks.tables import overwrite_partition

    spark = df.sparkSession
    if spark.catalog.tableExists(target):
        table = spark.table(target).schema
        if BATCH not in table.names:
            raise ValueError(f"{target} was not made by an ingest: it has no column {BATCH}")
        have = {n.lower() for n in table.names}
        fresh = [f for f in df.schema.fields if f.name.lower() not in have]
        if fresh:
            spark.sql(f"ALTER TABLE {target} ADD COLUMNS ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in fresh)})")
            spark.catalog.refreshTable(target)
        given = {c.lower(): c for c in df.columns}
        df = df.select(
            *[
                F.col(f"`{given[f.name.lower()]}`").alias(f.name) if f.name.lower() in given
                else F.lit(None).cast(f.dataType).alias(f.name)
                for f in spark.table(target).schema.fields
            ]
        )
    overwrite_partition(df, target, BATCH)


def ingest_available(
    spark: SparkSession,
    source_path: str,
    base_path: str,
    name: str,
    target: str,
    fmt: str = "csv",
    max_files: int | None = None,
    timeout: int | None = None,
    schema: StructType | str | None = None,
    evolve: bool = True,
    **options,
) -> None:
    """Load every file not seen before into table ``target``, then stop.

    Progress lives under ``base_path/checkpoints/name`` and the schema log under
    ``base_path/schemas/name``, so each dataset resumes on its own with the newest
    version.  ``max_files`` (1,000) bounds one micro-batch.  The target has the tracked
    columns, ``_rescued`` and the partition column ``_batch``.  ``schema`` starts the log;
    with ``evolve=False`` new columns are rescued instead of added.
    """
    from lakeops.sinks.streams import for_each_batch

    log = SchemaLog(spark, f"{base_path}/schemas/{name}")
    if schema is not None and log.newest() is None:
        log.add(schema if isinstance(schema, StructType) else StructType.fromDDL(schema))

    def load(files: DataFrame, batch: int) -> None:
        own = files.sparkSession
        paths = [r.path for r in files.select("path").collect()]  # at most max_files
        groups = _groups(own, paths, fmt, options) if paths else {}
        if not groups:
            return
        tracked = log.newest()
        known = {n.lower() for n in tracked.names} if tracked else set()
        parts = [_read(own, source_path, schema, some, fmt, options) for schema, some in groups.values()]
        heads = [StructType([f for f in part.schema.fields if f.name != RECORD]) for part in parts]
        if tracked is None or (evolve and any(n.lower() not in known for head in heads for n in head.names)):
            fresh = [p for schema, some in groups.values() if any(n.lower() not in known for n in schema.names) for p in some]
            found = list(_inferred(own, fresh, fmt, options).fields) if fresh else []
            # columns from folder names are typed by the read itself
            found += [f for head, (schema, _) in zip(heads, groups.values()) for f in head.fields if f.name not in schema.names]
            tracked = log.add(evolved(tracked or StructType([]), heads, StructType(found)))
        parts = [conform(part, tracked, options) for part in parts]
        rows = parts[0]
        for part in parts[1:]:
            rows = rows.unionByName(part)
        _store(rows.withColumn(BATCH, F.lit(batch).cast("bigint")), target)

    arrived = (
        spark.readStream.schema(FILES).options(**options).option("maxFilesPerTrigger", max_files or MAX_FILES)
        .format("binaryFile").load(source_path)
    )
    for_each_batch(arrived.select("path"), load, f"{base_path}/checkpoints/{name}", timeout=timeout)
    if spark.catalog.tableExists(target):  # batches run in a session of their own
        spark.catalog.refreshTable(target)
