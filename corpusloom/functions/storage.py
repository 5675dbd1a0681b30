"""Tables in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a temporary folder, removed at the end, only where that is unset and the master is local."""
    given = spark.conf.get("spark.checkpoint.dir", None)
    if given:
        return given.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        folder = tempfile.mkdtemp(prefix="spark-core-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        _OWN[app] = "file://" + folder
    return _OWN[app]


def fresh_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_folder(spark)}/core-{spark.sparkContext.applicationId}/{tag}-{uuid.uuid4().hex}"


def written(df: DataFrame, tag: str) -> DataFrame:
    """``df`` as a written table: later steps read the same rows in the same partitions, whichever executors are lost."""
    path = fresh_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Delete every table that ``written`` and the streams of this application left in the shared folder, once no result that reads them is needed any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/core-{spark.sparkContext.applicationId}")
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
