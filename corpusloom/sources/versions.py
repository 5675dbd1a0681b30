"""Tables kept under one path: scopes replaced in place, and whole versions published by one pointer."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators.review import fingerprint


def _hadoop(spark: SparkSession, path: str):
    """(file system, path) of a path in whatever store it names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def replace_scopes(path: str, rows: DataFrame, scope: str, scopes: list[str]) -> DataFrame:
    """Delete the named scopes of the table at ``path`` and insert ``rows``, which may only be of these; returns the table.

    The table is partitioned by ``scope`` and only the partitions named are
    rewritten: files of others stay as they are.  A named scope without rows is
    left empty.  A row of any other scope, or of none, stops the call before anything is written.
    """
    spark = rows.sparkSession
    held = rows.groupBy(scope).agg(F.count(F.lit(1)).alias("n"))
    strange = held.filter(~F.coalesce(F.col(scope).isin(scopes), F.lit(False))).select(scope).limit(5).collect()
    if strange:
        raise ValueError(f"rows of scopes that are not replaced: {[r[0] for r in strange]}")
    filled = {r[0] for r in held.select(scope).collect()}  # at most the scopes named
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(scope).parquet(path)
    for empty in sorted(set(scopes) - filled):
        fs, target = _hadoop(spark, f"{path}/{scope}={empty}")
        fs.delete(target, True)
    return read_scopes(spark, path, rows)


def read_scopes(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    return spark.read.schema(like.schema).parquet(path).select(*like.columns)


class VersionedTable:
    """Whole versions of a table beside each other, of which the pointer with the highest number names the one that holds.

    A version is written to a folder of its own and is nothing before its
    pointer exists; a job that fails or is killed in between leaves the version
    before it in force.  A pointer is made by one rename that fails where
    another writer made the same number first.  Names are in whatever store ``path`` is.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def pointers(self) -> list[int]:
        fs, folder = _hadoop(self.spark, f"{self.path}/pointers")
        return sorted(int(s.getPath().getName()) for s in fs.listStatus(folder) if s.getPath().getName().isdigit()) if fs.exists(folder) else []

    def receipt(self) -> DataFrame | None:
        """The one row of the pointer that holds: version, receipt; None before the first."""
        numbers = self.pointers()
        return self.spark.read.schema("version string, receipt string").json(f"{self.path}/pointers/{numbers[-1]}") if numbers else None

    def current(self) -> DataFrame | None:
        held = self.receipt()
        return None if held is None else self.spark.read.parquet(f"{self.path}/{held.first()['version']}")

    def stage(self, rows: DataFrame) -> str:
        """Write a version that does not hold yet; returns its name."""
        name = f"version-{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.path}/{name}")
        return name

    def publish(self, version: str, receipt: str, after: int | None = None) -> int:
        """Let a staged version hold; ``after`` is the pointer it was built upon (default: the one that holds). Fails if that is no longer the last."""
        number = (self.pointers() or [0])[-1] if after is None else after
        fs, folder = _hadoop(self.spark, f"{self.path}/pointers")
        fs.mkdirs(folder)
        _, draft = _hadoop(self.spark, f"{self.path}/drafts/{uuid.uuid4().hex}")
        self.spark.createDataFrame([(version, receipt)], "version string, receipt string").coalesce(1).write.json(draft.toString())
        _, final = _hadoop(self.spark, f"{self.path}/pointers/{number + 1}")
        if fs.exists(final) or not fs.rename(draft, final):
            raise RuntimeError(f"another version was published after {number}")
        return number + 1


def reimport(store: VersionedTable, incoming: DataFrame, dependents: DataFrame, key: str, text: str) -> str:
    """'noop' where the incoming rows are those that hold, 'reject' where they differ and something depends on them, else 'replace': the rows then hold.

    Rows are compared by a digest that counts repeated rows; the receipt of a version is that digest.
    """
    whole = lambda df: fingerprint(df.withColumn("_all", F.lit(0)), "_all", key, text).first()  # noqa: E731  one row
    new, held, base = whole(incoming), store.receipt(), (store.pointers() or [0])[-1]
    new_receipt = new["fingerprint"] if new else ""
    if held is not None:
        if held.first()["receipt"] == new_receipt:
            return "noop"
        if not dependents.isEmpty():
            return "reject"
    store.publish(store.stage(incoming), new_receipt, base)
    return "replace"
