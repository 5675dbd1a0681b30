"""Ordered folds: rows of a key in order, each put into a unit by a rule that looks at the unit so far.

The rows are shuffled by key and sorted; a task streams them and keeps one
small state, carried across Arrow batches and reset where the key changes.
No group is held in memory.  A single key is one stream: give a finer key (a
section) where one key holds a large part of the rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import BooleanType, DataType, LongType, StructType

#: Decides before (rows in the unit, cost of the unit, cost of the row, number of the unit): 'add', 'new' (start a unit) or 'last' (add, then close).
Rule = Callable[[int, float, float, int], str]


def fold_rows(df: DataFrame, keys: list[str], order: list[Column], columns: list[str], step: Callable, name: str, kind: DataType) -> DataFrame:
    """``df`` with ``name``: step(state, *values of columns) gives the next state and the row's value; the state is None at a key's first row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, at = object(), None, len(keys)
        for b in batches:
            out = []
            for row in zip(*(b.column(x).to_pylist() for x in (*keys, *columns))):
                if row[:at] != key:
                    key, state = row[:at], None
                state, value = step(state, *row[at:])
                out.append(value)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, arrow_kind)], names=[*b.schema.names, name])

    arrow_kind = to_arrow_type(kind)
    ordered = df.drop(name).repartition(*keys).sortWithinPartitions(*keys, *order)
    return ordered.mapInArrow(run, StructType(ordered.schema.fields[:]).add(name, kind))


def fold_units(df: DataFrame, keys: list[str], order: list[Column], cost: str, rule: Rule, name: str = "unit") -> DataFrame:
    """``df`` with the 0-based number of each row's unit inside its key."""

    def step(state: tuple | None, c: float) -> tuple[tuple, int]:
        unit, count, total, closed = state or (0, 0, 0, False)
        if closed:
            unit, count, total = unit + 1, 0, 0
        what = rule(count, total, c, unit)
        if what == "new" and count:
            unit, count, total = unit + 1, 0, 0
        return (unit, count + 1, total + c, what == "last"), unit

    return fold_rows(df, keys, order, [cost], step, name, LongType())


def chapter_points(df: DataFrame, keys: list[str], part: str, order: list[Column], start: str, end: str, every: float = 600, apart: float = 10, least: int = 3, shortest: float = 30) -> DataFrame:
    """The rows of an output (keys) at which a chapter starts, in order of their start.

    Candidates are the first row, rows whose ``part`` is not the one before,
    and the first row at or past each target, which is ``every`` after the last
    target's row; one that follows the last kept within ``apart`` is dropped.
    Outputs with fewer than ``least`` points, or shorter than ``shortest``, have none.
    """

    def step(state: tuple | None, p: object, s: float) -> tuple[tuple, bool]:
        if state is None:
            return (p, s + every, s), True
        before, target, kept = state
        due = p != before or s >= target
        keep = due and s - kept >= apart
        return (p, s + every if s >= target else target, s if keep else kept), keep

    marked = fold_rows(df, keys, order, [part, start], step, "_point", BooleanType())
    per = marked.groupBy(*keys).agg(F.count_if("_point").alias("_n"), F.min(start).alias("_a"), F.max_by(end, F.struct(*order)).alias("_b"))
    good = per.filter((F.col("_n") >= least) & (F.col("_b") - F.col("_a") >= shortest)).select(*keys)
    return marked.filter("_point").drop("_point").join(good, keys, "left_semi")


def greedy(max_items: int, max_cost: float, separator: float = 0) -> Rule:
    """Start a unit where it would exceed the limits; an oversized row is a unit of its own.

    ``separator`` is added once per row already in the unit, when the next is tested.
    """

    def rule(count: int, total: float, cost: float, unit: int) -> str:
        return "new" if count >= max_items or total + cost + separator * count > max_cost else "add"

    return rule


def nearest_to(target: float) -> Rule:
    """Close before or after the row that crosses the target, whichever leaves the unit nearer to it."""

    def rule(count: int, total: float, cost: float, unit: int) -> str:
        if total + cost < target:
            return "add"
        return "new" if count and target - total <= total + cost - target else "last"

    return rule


def canary(max_cost: float) -> Rule:
    """The first row alone, the rest packed by cost."""

    def rule(count: int, total: float, cost: float, unit: int) -> str:
        return "last" if unit == 0 else "new" if total + cost > max_cost else "add"

    return rule


def alone_if(limit: float, max_items: int, max_cost: float) -> Rule:
    """Rows over ``limit`` stand alone; the others are packed."""

    def rule(count: int, total: float, cost: float, unit: int) -> str:
        if cost > limit:
            return "new"
        return "new" if count >= max_items or total > limit and count == 1 or total + cost > max_cost else "add"

    return rule


def titled(first: Column, title: Column, text: Column) -> Column:
    """The part that a row puts into its unit: its text, after the title where it is the first of its collection."""
    return F.concat(F.when(first, title).otherwise(F.lit("")), F.trim(text))


def pack_bounded(df: DataFrame, keys: list[str], boundaries: list[str], order: list[Column], cost: str, target: float, hard: float, separator: float = 1, max_items: int = 1 << 31) -> tuple[DataFrame, DataFrame]:
    """(units, refused): ``df`` with the number of each row's unit inside its key; rows whose own cost is over ``hard``.

    A unit ends where a boundary column changes or ``target`` would be passed, one ``separator`` between rows counted.  Boundaries are
    part of the key of the fold, so a key is no single stream where its sections are many; numbers go on over them in their order.
    Nothing is packed around a row that no unit may hold: as long as ``refused`` has rows of a key, that key has no unit.
    """
    refused = df.filter(F.col(cost) > hard)
    able = df.join(refused.select(*keys).distinct(), keys, "left_anti")
    inner = fold_units(able, [*keys, *boundaries], order, cost, greedy(max_items, target, separator), "_u")
    counts = inner.groupBy(*keys, *boundaries).agg((F.max("_u") + 1).alias("_n"))
    before = Window.partitionBy(*keys).orderBy(*boundaries).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, *boundaries, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_o"))
    return inner.join(offsets, [*keys, *boundaries]).withColumn("unit", F.col("_o") + F.col("_u")).drop("_o", "_u"), refused


def short_spans(df: DataFrame, keys: list[str], order: list[Column], text: str, duration: str, letters: int = 95, seconds: float = 10, max_items: int = 4, max_letters: int = 250) -> DataFrame:
    """``df`` with ``unit``: spans of at most ``letters`` characters and ``seconds`` stand together, up to ``max_items`` of ``max_letters`` in all; any other stands alone."""

    def step(state: tuple | None, size: int, short: bool) -> tuple[tuple, int]:
        unit, count, total, closed = state or (0, 0, 0, False)
        new = count and (closed or not short or count >= max_items or total + size > max_letters)
        unit, count, total = (unit + 1, 0, 0) if new else (unit, count, total)
        return (unit, count + 1, total + size, not short), unit

    sized = df.withColumns({"_size": F.length(text), "_short": (F.length(text) <= letters) & (F.col(duration) <= seconds)})
    return fold_rows(sized, keys, order, ["_size", "_short"], step, "unit", LongType()).drop("_size", "_short")


def unit_table(df: DataFrame, keys: list[str], cost: str, name: str = "unit") -> DataFrame:
    return df.groupBy(*keys, name).agg(F.count(F.lit(1)).alias("n_items"), F.sum(cost).alias("total"))


def balanced_split(df: DataFrame, key: str, order: list[str], cost: str, parts: int) -> DataFrame:
    """``df`` with ``unit``: a key's rows in ``parts`` runs of about equal cost.

    A part closes where the running cost reaches its share of the total, once per row at most.  The greedy rule has a closed form over
    running sums, valid where a key has at least ``parts`` rows left for the parts that remain.
    """
    totals = df.groupBy(key).agg(F.sum(cost).alias("_t"))
    along = Window.partitionBy(key).orderBy(*order)
    so_far = along.rowsBetween(Window.unboundedPreceding, 0)
    placed = df.join(totals, key).withColumn("_i", F.row_number().over(along))
    due = placed.withColumn("_due", F.floor(F.sum(cost).over(so_far) * parts / F.col("_t")) - (F.col("_i") - 1)).withColumn("_low", F.min("_due").over(so_far))
    closed = due.withColumn("_closed", F.col("_i") - 1 + F.least(F.lit(1), F.col("_low")))
    before = F.coalesce(F.lag("_closed").over(along), F.lit(0))
    return closed.withColumn("unit", F.least(F.lit(parts - 1), before).cast("long")).drop("_t", "_i", "_due", "_low", "_closed")


def sliding_view(words: Column, at: Column, size: int) -> Column:
    """The ``size`` words shown with the word at 0-based place ``at``: it second where there is room on both sides."""
    start = F.greatest(F.lit(0), F.least(at - 1, F.size(words) - size)) + 1
    return F.slice(words, start, F.lit(size))


def dated_plan(candidates: DataFrame, key: str, order: str, first_day: str, days: int, variants: list[str]) -> DataFrame:
    """(key, day, variant, order): the candidates of a key along ``order`` on consecutive days, variants in turn; days without a candidate have null."""
    numbered = candidates.select(key, order, F.row_number().over(Window.partitionBy(key).orderBy(order)).alias("_k"))
    slots = candidates.select(key).distinct().withColumn("_k", F.explode(F.sequence(F.lit(1), F.lit(days))))
    day = F.date_add(F.lit(first_day).cast("date"), F.col("_k") - 1)
    variant = F.element_at(F.array(*map(F.lit, variants)), ((F.col("_k") - 1) % len(variants) + 1).cast("int"))
    return slots.join(numbered, [key, "_k"], "left").select(key, F.date_format(day, "yyyy-MM-dd").alias("day"), variant.alias("variant"), order)
