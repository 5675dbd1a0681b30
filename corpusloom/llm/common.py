"""Helpers shared by the corpus operators: intermediate tables, table access, free column names and global row numbers."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import weakref

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_OWN_DIRS: dict[str, str] = {}
_WRITTEN: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``); a temporary one of its own only on a local master."""
    given = spark.conf.get("spark.checkpoint.dir", None)
    if given:
        return given.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN_DIRS:
        folder = tempfile.mkdtemp(prefix="spark-loom-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        _OWN_DIRS[app] = "file://" + folder
    return _OWN_DIRS[app]


def new_path(spark: SparkSession, tag: str) -> str:
    """A path of its own under the folder of this application, ``loom-<application id>``."""
    return f"{shared_dir(spark)}/loom-{spark.sparkContext.applicationId}/{tag}-{uuid.uuid4().hex}"


def delete_path(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def release_tables(spark: SparkSession) -> None:
    """Delete every intermediate table of this application, once no result that reads them is needed any more."""
    delete_path(spark, f"{shared_dir(spark)}/loom-{spark.sparkContext.applicationId}")


def materialize(df: DataFrame, tag: str, instead_of: DataFrame | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts lineage and survives lost executors.

    ``instead_of`` is an earlier result of this function that nothing reads once this one is written; its files go.
    """
    path = new_path(df.sparkSession, tag)
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    _WRITTEN[out] = path
    if instead_of is not None and instead_of in _WRITTEN:
        delete_path(df.sparkSession, _WRITTEN.pop(instead_of))
    return out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, each with so many underscores before it that no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def with_row_number(df: DataFrame, order: list[Column], name: str, tag: str = "ordinal") -> tuple[DataFrame, int]:
    """Global 0-based row numbers along ``order`` and the row count; a column called ``name`` is replaced, all others stay.

    Range partitions are numbered inside themselves; the offsets come from one
    row per partition, so no task sees more than its own partition.
    """
    mid, pid, rows, offset = free_names(df, "_mid", "_pid", "_n", "_offset")
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(mid, F.monotonically_increasing_id())
    ranged = materialize(ranged, tag).withColumn(pid, F.shiftright(mid, 33))
    counts = ranged.groupBy(pid).agg(F.count(F.lit(1)).alias(rows))
    before = Window.orderBy(pid).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(pid, F.coalesce(F.sum(rows).over(before), F.lit(0)).alias(offset))
    total = counts.agg(F.coalesce(F.sum(rows), F.lit(0))).first()[0]
    local = F.col(mid).bitwiseAND(F.lit((1 << 33) - 1))
    numbered = ranged.join(F.broadcast(offsets), pid)  # one row per range partition
    return numbered.withColumn(name, F.col(offset) + local).drop(mid, pid, offset), int(total)
