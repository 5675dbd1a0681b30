"""Running a stream over what a folder holds now, into a table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corpusloom.functions.storage import fresh_path


PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def drain(spark: SparkSession, path: str, job: Callable[[DataFrame], DataFrame], files: int | None = None, provider: str | None = None) -> DataFrame:
    """Stream the Parquet files under ``path`` (a folder or file) through ``job`` until nothing is left, and return the sink's rows.

    ``files``: at most so many files a micro-batch; ``provider``: class of the state stores, set for this run only.
    Sink and stream checkpoint lie in the folder of ``spark.checkpoint.dir``; a local one only where none is set.
    """
    base = fresh_path(spark, "stream")
    schema = spark.read.parquet(path).schema
    folder, _, name = path.rpartition("/")
    reader = spark.readStream.schema(schema)
    reader = reader.option("maxFilesPerTrigger", files) if files else reader
    before = spark.conf.get(PROVIDER, None)
    if provider:
        spark.conf.set(PROVIDER, provider)
    try:
        out = job(reader.parquet(f"{folder}/[{name[0]}]{name[1:]}"))
        run = out.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/log").outputMode("append")
        run.trigger(availableNow=True).start().awaitTermination()
    finally:
        if provider:
            spark.conf.unset(PROVIDER) if before is None else spark.conf.set(PROVIDER, before)
    return spark.read.schema(out.schema).parquet(f"{base}/out")
