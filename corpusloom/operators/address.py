"""Addresses ``coll:seq``: parsing, ranges, labels, neighbour context, sections and coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.ordinals import global_ordinal

REF = r"^(\d{1,3}):(\d{1,3})$"


def parse_ref(ref: Column) -> Column:
    """struct(coll, seq) of a strict reference, null if it is none."""
    part = lambda i: F.regexp_extract(ref, REF, i).cast("long")
    return F.when(ref.rlike(REF), F.struct(part(1).alias("coll"), part(2).alias("seq")))


def in_range(coll: Column, seq: Column, start: tuple[int, int] | None, end: tuple[int, int] | None) -> Column:
    """Whether (coll, seq) lies between two addresses; None leaves an end open."""
    here = F.struct(coll.cast("long"), seq.cast("long"))
    pair = lambda x: F.struct(F.lit(x[0]).cast("long"), F.lit(x[1]).cast("long"))
    out = F.lit(True)
    if start:
        out = out & (here >= pair(start))
    if end:
        out = out & (here <= pair(end))
    return out


def expand_range(df: DataFrame, first: str, last: str, name: str = "seq") -> DataFrame:
    """One row per position of each range; empty ranges vanish."""
    return df.filter(F.col(first) <= F.col(last)).withColumn(name, F.explode(F.sequence(first, last)))


def range_label(c1: Column, s1: Column, c2: Column, s2: Column, name: str) -> Column:
    """``L c:a``, ``L c:a-b`` or ``c:a-d:b``."""
    one = F.concat(F.lit(f"{name} "), c1, F.lit(":"), s1)
    return F.when((c1 == c2) & (s1 == s2), one).when(c1 == c2, F.concat(one, F.lit("-"), s2)).otherwise(F.concat(c1, F.lit(":"), s1, F.lit("-"), c2, F.lit(":"), s2))


def neighbour_context(units: DataFrame, items: DataFrame, before: int, after: int) -> DataFrame:
    """Items within ``before`` and ``after`` positions of each unit, inside its collection; an equi-join on the address.

    units: unit_id, coll, first, last; items: coll, seq, ...
    """
    wide = units.withColumn("seq", F.explode(F.sequence(F.col("first") - before, F.col("last") + after)))
    where = F.when(F.col("seq") < F.col("first"), "before").when(F.col("seq") > F.col("last"), "after").otherwise("own")
    return wide.withColumn("place", where).join(items, ["coll", "seq"])


def coverage_diff(expected: DataFrame, actual: DataFrame, keys: list[str]) -> DataFrame:
    """keys and problem: 'missing' where only expected, 'unexpected' where only actual."""
    missing = expected.select(*keys).distinct().join(actual, keys, "left_anti").withColumn("problem", F.lit("missing"))
    extra = actual.select(*keys).distinct().join(expected, keys, "left_anti").withColumn("problem", F.lit("unexpected"))
    return missing.unionByName(extra)


def dense_check(df: DataFrame, coll: str, seq: str) -> DataFrame:
    """Per collection: rows, first, last, whether positions are 1..n without holes or repeats."""
    out = df.groupBy(coll).agg(F.count(F.lit(1)).alias("n"), F.min(seq).alias("first"), F.max(seq).alias("last"), F.count_distinct(seq).alias("distinct_n"))
    return out.withColumn("dense", (F.col("first") == 1) & (F.col("last") == F.col("n")) & (F.col("distinct_n") == F.col("n")))


def section_check(sections: DataFrame, total: int) -> DataFrame:
    """Sections (section, first, last) with what breaks their contiguity; each meets the one before by its ordinal."""
    numbered = global_ordinal(sections, ["section"], "_no")
    prior = numbered.select((F.col("_no") + 1).alias("_no"), F.col("last").alias("_prev"))
    gap = F.col("first") - F.coalesce("_prev", F.lit(0)) - 1
    out = numbered.join(prior, "_no", "left").withColumn("gap", gap).drop("_no", "_prev")
    return out.withColumn("size", F.col("last") - F.col("first") + 1).withColumn("beyond", F.greatest(F.lit(0), F.col("last") - F.lit(total)))
