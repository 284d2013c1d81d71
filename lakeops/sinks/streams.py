"""Streaming sinks.  Every batch write is idempotent by batch id."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.operators.ordered import names
from lakeops.sinks.tables import upsert_batch
from lakeops.session import new_dir


def to_messages(df: DataFrame, key_cols: Sequence[str] | None = None) -> DataFrame:
    """Each row as a JSON ``value`` (and a JSON ``key``)."""
    value = F.to_json(F.struct("*")).alias("value")
    if not key_cols:
        return df.select(value)
    return df.select(F.to_json(F.struct(*key_cols)).alias("key"), value)


def finish(query, timeout: int | None = None) -> None:
    """Wait for an available-now query; with ``timeout`` seconds given, an overrun is stopped and reported."""
    try:
        if timeout is None:
            query.awaitTermination()
        elif not query.awaitTermination(timeout):
            raise TimeoutError(f"stream did not finish in {timeout} s")
    finally:
        query.stop()


def stream_to_table(
    stream: DataFrame, target: str, checkpoint: str, trigger: str = "available", timeout: int | None = None
) -> None:
    """Exactly-once append of a stream to a table or, with a slash, a Parquet folder."""
    writer = stream.writeStream.option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if trigger == "available" else writer.trigger(processingTime=trigger)
    if "/" in target:
        query = writer.format("parquet").option("path", target).start()
    else:
        query = writer.toTable(target)
    if trigger == "available":
        finish(query, timeout)
        return None
    return query


def for_each_batch(
    stream: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str = "append",
    timeout: int | None = None,
) -> None:
    """Run an available-now stream whose batches ``write`` stores."""
    query = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )
    finish(query, timeout)


def row_sink(
    stream: DataFrame,
    target: str,
    checkpoint: str,
    keys: str | Sequence[str] | None = None,
    order_col: str | None = None,
    mode: str = "append",
    fmt: str | None = None,
    options: dict[str, str] | None = None,
    buckets: int = 64,
    timeout: int | None = None,
    clear: Callable[[int], None] | None = None,
) -> None:
    """Rows of a stream into a keyed table, set by set.

    With ``keys`` the table keeps one row per key; ``fmt`` sends the batches to
    an outside row store (JDBC and the like) instead.  Rows sent outside carry their batch in
    ``_batch``, and ``clear(batch_id)`` is called first to remove what an earlier attempt of the
    batch has left there; without it a replayed batch is stored twice.
    """
    keys = names(keys)

    def write(batch: DataFrame, batch_id: int) -> None:
        if fmt:
            if clear:
                clear(batch_id)
            marked = batch.withColumn("_batch", F.lit(int(batch_id)))
            marked.write.format(fmt).options(**(options or {})).mode("append").save()
        elif keys:
            upsert_batch(batch, target, keys, order_col, buckets)
        else:
            # one folder per batch id: a replayed batch replaces itself
            batch.write.mode("overwrite").parquet(f"{target}/batch={int(batch_id)}")

    for_each_batch(stream, write, checkpoint, mode, timeout)


def keep_last_result(stream: DataFrame, path: str, checkpoint: str, timeout: int | None = None) -> None:
    """Store the full result table of a complete-mode query after each batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(path)

    for_each_batch(stream, write, checkpoint, "complete", timeout)


def route(df: DataFrame, rules: dict[str, Column]) -> dict[str, DataFrame]:
    """One filtered frame per target; a row goes to every target whose rule holds."""
    return {target: df.filter(F.coalesce(rule, F.lit(False))) for target, rule in rules.items()}


def route_stream(
    stream: DataFrame, rules: dict[str, Column], root: str, checkpoint: str, timeout: int | None = None
) -> None:
    """Fan a stream out to ``root/<target>``; each batch is read once and kept for all rules."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for target, part in route(batch, rules).items():
                part.write.mode("overwrite").parquet(f"{root}/{target}/batch={int(batch_id)}")
        finally:
            batch.unpersist()

    for_each_batch(stream, write, checkpoint, "append", timeout)


def scratch(stream: DataFrame, name: str) -> tuple[str, str]:
    """A fresh (output, checkpoint) pair in the shared folder."""
    base = new_dir(stream.sparkSession, name)
    return f"{base}/out", f"{base}/checkpoint"
