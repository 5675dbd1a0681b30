"""Global ordinals and prefix sums without a single-partition sort."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.storage import written


def global_ordinal(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """1-based position of each row along ``order``.

    Rows are range-partitioned, numbered inside their partition and written
    once, so that the offsets - a running sum over one row per partition - are
    those of the rows they are added to.  Rows equal along ``order`` are spread
    by where they come from, so many equal ones are no single partition.
    """
    told = df.withColumn("_tie", F.monotonically_increasing_id())
    ranged = told.repartitionByRange(*order, "_tie").sortWithinPartitions(*order, "_tie").drop("_tie").withColumn("_i", F.monotonically_increasing_id())
    ranged = written(ranged, "ordinal").withColumn("_p", F.shiftright("_i", 33))
    counts = ranged.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_o"))
    here = F.col("_i").bitwiseAND(F.lit((1 << 33) - 1))
    return ranged.join(F.broadcast(offsets), "_p").withColumn(name, F.col("_o") + here + 1).drop("_p", "_i", "_o")


def keyed_ordinal(df: DataFrame, keys: list[str], order: list[str], name: str) -> DataFrame:
    """1-based position of each row along ``order`` inside its key; a key with most of the rows is spread over range partitions like any other."""
    placed = global_ordinal(df, [*keys, *order], name)
    if not keys:
        return placed
    firsts = placed.groupBy(*keys).agg(F.min(name).alias("_first")).select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_first")
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return placed.join(firsts, same).withColumn(name, F.col(name) - F.col("_first") + 1).drop("_first", *[f"_k{i}" for i in range(len(keys))])


def rows_at(df: DataFrame, keys: list[str], order: list[str], wanted: DataFrame, place: str) -> DataFrame:
    """The rows of ``df`` at the wanted 1-based places (keys, place) along ``order`` inside their keys, with ``place``."""
    return keyed_ordinal(df, keys, order, place).join(wanted.distinct(), [*keys, place])
