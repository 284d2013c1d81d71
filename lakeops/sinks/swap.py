"""Replace single files of a table without partitions.

The new files are written to a hidden folder of the table; a small list of the files they stand
for decides the swap.  From then on whoever comes next can finish it: moving a file that has been
moved, or deleting one that is gone, does nothing.  A swap without its list never counts.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession

PLACE = "_lakeops_swap"


def file_of(rows: DataFrame) -> Column:
    return rows.metadataColumn("_metadata")["file_path"]


def files_with(rows: DataFrame, hit: Column) -> list[str]:
    """Files that hold a row where ``hit`` is true: a part of the listing the driver plans scans from."""
    found = rows.filter(hit).select(file_of(rows).alias("path")).distinct()
    return sorted(r.path for r in found.toLocalIterator())


def swap_files(spark: SparkSession, location: str, fmt: str, old: Sequence[str], rows: DataFrame) -> None:
    """Put ``rows`` in place of the files ``old``."""
    place = f"{location.rstrip('/')}/{PLACE}/{uuid.uuid4().hex}"
    rows.write.format(fmt).save(f"{place}/new")
    spark.createDataFrame([(p,) for p in old], "path string").coalesce(1).write.text(f"{place}/old")
    finish_swaps(spark, location)


def finish_swaps(spark: SparkSession, location: str) -> None:
    """Finish every decided swap below ``location``; new files come before old ones go."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path
    base, root = path(location), path(location, PLACE)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return
    for status in fs.listStatus(root):
        place = status.getPath()
        listed, new = path(place, "old"), path(place, "new")
        if not fs.exists(path(listed, "_SUCCESS")):
            continue
        for made in fs.listStatus(new) if fs.exists(new) else ():
            name = made.getPath().getName()
            if not name.startswith(("_", ".")) and not fs.rename(made.getPath(), path(base, name)):
                raise OSError(f"could not move {made.getPath()} to {location}")
        for row in spark.read.text(listed.toString()).toLocalIterator():
            fs.delete(path(jvm.java.net.URI(row.value)), False)
        fs.delete(place, True)
