"""Sections given as ranges of positions, of any length, laid over ordered items."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.ordinals import global_ordinal
from corpusloom.functions.storage import written


def assign_sections(items: DataFrame, sections: DataFrame, position: str) -> DataFrame:
    """``items`` with the ``section`` of the last range that begins at or before them; null where that range has ended, or before the first.

    sections: section, first, last.  Range starts and items are put in one
    order by range partitions; inside a partition the last start is carried on,
    and what a partition ends with is handed to those after it: one row a
    partition.  No range is expanded, none is broadcast, and no task needs more than its own partition.
    """
    none = F.lit(None).cast("struct<section:long,last:long>")
    mark = F.struct(F.col("section").cast("long").alias("section"), F.col("last").cast("long").alias("last"))
    starts = sections.filter("first <= last").select(F.col("first").cast("long").alias("_at"), F.lit(0).alias("_kind"), mark.alias("_mark"), F.lit(None).cast("long").alias("_row"))
    numbered = written(items.withColumn("_row", F.monotonically_increasing_id()), "sectioned")
    placed = numbered.select(F.col(position).cast("long").alias("_at"), F.lit(1).alias("_kind"), none.alias("_mark"), "_row")
    ranged = starts.unionByName(placed).repartitionByRange("_at").sortWithinPartitions("_at", "_kind", F.col("_mark.section").asc()).withColumn("_i", F.monotonically_increasing_id())
    ranged = written(ranged, "sections").withColumn("_p", F.shiftright("_i", 33))
    inside = Window.partitionBy("_p").orderBy("_i").rowsBetween(Window.unboundedPreceding, 0)
    here = ranged.withColumn("_here", F.last("_mark", ignorenulls=True).over(inside))
    ends = ranged.groupBy("_p").agg(F.max_by("_mark", F.when(F.col("_mark").isNotNull(), F.col("_i"))).alias("_end"))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    handed = ends.select("_p", F.last("_end", ignorenulls=True).over(before).alias("_handed"))
    carried = here.filter("_kind = 1").join(F.broadcast(handed), "_p").select("_row", "_at", F.coalesce("_here", "_handed").alias("_m"))
    found = carried.select("_row", F.when(F.col("_at") <= F.col("_m.last"), F.col("_m.section")).alias("section"))
    return numbered.drop("section").join(found, "_row").drop("_row")


def section_audit(assigned: DataFrame, sections: DataFrame) -> DataFrame:
    """(section, items, problem): one row for each thing wrong with a range, and one for each that is right.

    sections: section, first, last, expected.  'empty_range' (it ends before it begins), 'gap' or 'overlap' with the one before
    in order of first, 'count' (other than expected items begin in it and no later range).
    """
    counted = assigned.groupBy("section").agg(F.count(F.lit(1)).alias("items"))
    numbered = global_ordinal(sections, ["first", "section"], "_no")
    prior = numbered.select((F.col("_no") + 1).alias("_no"), F.col("last").alias("_prev"))
    joined = numbered.join(prior, "_no", "left").join(counted, "section", "left").withColumn("items", F.coalesce("items", F.lit(0)))
    checks = [
        ("empty_range", F.col("last") >= F.col("first")),
        ("gap", F.col("_prev").isNull() | (F.col("first") <= F.col("_prev") + 1)),
        ("overlap", F.col("_prev").isNull() | (F.col("first") > F.col("_prev"))),
        ("count", F.col("items") == F.col("expected")),
    ]
    wrong = F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), name) for name, ok in checks]))
    return joined.select("section", "items", F.explode(F.when(F.size(wrong) > 0, wrong).otherwise(F.array(F.lit("ok")))).alias("problem"))
