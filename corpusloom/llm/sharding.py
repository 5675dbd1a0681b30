"""Reproducible shuffle and sharding by a Feistel permutation over global row numbers.

``y = permute(row_number)`` is a bijection of 0..n-1, so ``shard = y mod
shards`` and ``slot = y div shards`` are computable for any row without
looking at the others, shard counts differ by one at most, and slots have no
gaps.  The domain is an a*b grid just above n; values that leave 0..n-1 walk
the cycle until they are back inside.  A walk visits each cell outside 0..n-1
once at most, so the sides are chosen to leave few such cells and the walk is
as long as their number: no value can stay outside.

Defined edge cases: null doc_ids sort first; null texts have 0 bytes and the
CRC of the empty text; rows equal in every ordering column are
interchangeable; repeated or null doc_ids are rows like others; an empty table
gives an empty result.  Columns named like the outputs are replaced, all others
kept.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.common import free_names, table, with_row_number

ROUNDS = 4
SIDES = 1 << 20  # sides to choose from


def grid(n: int) -> tuple[int, int, int]:
    """Sides of a near-square grid that holds n cells and few more, and the steps after which a cycle walk has left those."""
    n = max(1, n)
    least = math.isqrt(n - 1) + 1
    sides = np.arange(least, least + min(least, SIDES), dtype=np.int64)
    spare = -n % sides
    best = int(spare.argmin())
    a = int(sides[best])
    return a, -(-n // a), int(spare[best]) + 1


def feistel(x: Column, n: int, seed: int) -> Column:
    """Permutation of 0..n-1 as a column expression, inside the JVM; the walk ends inside for every value (see ``grid``)."""
    a, b, walk = grid(n)

    def once(v: Column) -> Column:
        start = F.struct(F.floor(v / F.lit(b)).alias("l"), (v % F.lit(b)).alias("r"))

        def turn(s: Column, i: Column) -> Column:
            left = (s["l"] + F.pmod(F.xxhash64(s["r"], i, F.lit(seed)), F.lit(a))) % F.lit(a)
            right = (s["r"] + F.pmod(F.xxhash64(left, i, F.lit(seed + 1)), F.lit(b))) % F.lit(b)
            return F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))

        typed = F.struct(start["l"].cast("long").alias("l"), start["r"].cast("long").alias("r"))
        keys = F.array(*[F.lit(k).cast("long") for k in range(ROUNDS)])
        return F.aggregate(keys, typed, turn, lambda s: s["l"] * F.lit(b) + s["r"])

    # floor of a double division is exact below 2**53 rows
    steps = F.sequence(F.lit(1), F.lit(walk))
    return F.aggregate(steps, once(x.cast("long")), lambda y, _: F.when(y < F.lit(n), y).otherwise(once(y)))


def assign_shards(df: DataFrame, order: list[Column], shards: int = 8, seed: int = 20240229) -> DataFrame:
    """Every row of ``df`` with ``shard`` and ``slot``; ``order`` fixes the global row numbers."""
    base = df.drop("shard", "slot")
    row, to = free_names(base, "_row", "_to")
    numbered, n = with_row_number(base, order, row, "shard")
    placed = numbered.withColumn(to, feistel(F.col(row), max(n, 1), seed))
    shard = (F.col(to) % F.lit(shards)).cast("int")
    slot = F.floor(F.col(to) / F.lit(shards)).cast("long")
    return placed.withColumn("shard", shard).withColumn("slot", slot).drop(row, to)


def op6_feistel_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    order = [F.col("doc_id").asc_nulls_first(), F.col("text_crc32").asc(), F.col("size").asc()]
    placed = assign_shards(rows, order)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


QUERIES = {"op6_feistel_sharding": op6_feistel_sharding}
ORACLES: dict[str, str] = {}
