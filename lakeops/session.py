"""Session settings and the shared scratch folder.

The library never depends on being handed its own session: every function takes
a ``SparkSession`` (or a DataFrame that carries one).  ``build_session`` is the
convenience used by the tests and the bench.
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even when that costs the next operator one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.ui.enabled": "false",
    # Up to this n, "first n per group" is cut in the map tasks before the shuffle.
    "spark.sql.optimizer.windowGroupLimitThreshold": "100000",
}


def build_session(app: str = "lakeops", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the library's defaults; keyword ``conf`` uses ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


@contextmanager
def session_conf(spark: SparkSession, values: dict[str, str]):
    """Set runtime options for one block and put the old ones back."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield spark
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


_LOCAL_ROOTS: dict[str, str] = {}


def work_root(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a fresh folder of its
    own; on a cluster a missing setting is an error, because a machine-local
    folder would not survive the loss of an executor.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = context.applicationId
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="lakeops-")
    return _LOCAL_ROOTS[app]


def new_dir(spark: SparkSession, name: str) -> str:
    """A path under :func:`work_root` that no other call has used."""
    return f"{work_root(spark).rstrip('/')}/lakeops/{name}-{uuid.uuid4().hex[:12]}"


def materialise(df, name: str = "stage"):
    """Cut lineage by writing ``df`` once to the shared folder and reading it back.

    Unlike a cached block the written files survive the loss of an executor, so
    several later passes over the result never redo the work before it.
    """
    path = new_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
