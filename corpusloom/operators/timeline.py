"""Time axes: ends, offsets, interpolation, monotonicity, snapshots, proportional splits and captions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_offset(df: DataFrame, keys: list[str], order: list[Column], amount: str, name: str = "offset") -> DataFrame:
    before = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn(name, F.coalesce(F.sum(amount).over(before), F.lit(0)))


def event_end(df: DataFrame, keys: list[str], order: list[Column], start: str, end: str, clip_end: Column) -> DataFrame:
    """End of an event: the later of its own end and the next start; the last one uses ``clip_end``."""
    following = F.lead(start).over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("event_end", F.greatest(F.col(end), F.coalesce(following, clip_end)))


def interpolate(df: DataFrame, keys: list[str], position: str, value: str, max_gap: int) -> DataFrame:
    """Fill nulls linearly between the nearest known neighbours, over gaps of at most ``max_gap`` rows; columns filled and source."""
    back = Window.partitionBy(*keys).orderBy(position).rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy(*keys).orderBy(position).rowsBetween(0, Window.unboundedFollowing)
    known = F.when(F.col(value).isNotNull(), F.struct(F.col(position).alias("p"), F.col(value).alias("v")))
    out = df.withColumn("_l", F.last(known, ignorenulls=True).over(back)).withColumn("_r", F.first(known, ignorenulls=True).over(ahead))
    share = (F.col(position) - F.col("_l.p")) / (F.col("_r.p") - F.col("_l.p"))
    middle = F.when(F.col("_r.p") - F.col("_l.p") - 1 <= max_gap, F.col("_l.v") + (F.col("_r.v") - F.col("_l.v")) * share)
    source = F.when(F.col(value).isNotNull(), "known").when(middle.isNotNull(), "interpolated").otherwise("unknown")
    return out.withColumn("filled", F.coalesce(F.col(value), middle)).withColumn("source", source).drop("_l", "_r")


def order_breaks(df: DataFrame, keys: list[str], order: list[Column], start: str, end: str) -> DataFrame:
    """Rows that end before they start or start before the one before them ends, with the problem."""
    prev = F.lag(end).over(Window.partitionBy(*keys).orderBy(*order))
    problem = F.when(F.col(end) <= F.col(start), "empty").when(F.col(start) < prev, "overlap")
    return df.withColumn("problem", problem).filter("problem is not null")


def proportional_split(df: DataFrame, keys: list[str], order: list[Column], weight: Column, start: str, duration: str) -> DataFrame:
    """Pieces share a span by weight (at least 1): piece_start, piece_end."""
    w = df.withColumn("_w", F.greatest(weight, F.lit(1)))
    so_far = F.sum("_w").over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    share = F.sum("_w").over(Window.partitionBy(*keys))
    at = lambda x: F.round(F.col(start) + F.col(duration) * x / share, 6)
    return w.withColumn("piece_start", at(so_far - F.col("_w"))).withColumn("piece_end", at(so_far)).drop("_w")


def clock(seconds: Column) -> Column:
    """HH:MM:SS,mmm of a time in seconds."""
    ms = F.round(seconds * 1000).cast("long")
    part = lambda div, mod: F.pmod(F.floor(ms / div), F.lit(mod)).cast("long")
    return F.format_string("%02d:%02d:%02d,%03d", F.floor(ms / 3600000), part(60000, 60), part(1000, 60), F.pmod(ms, F.lit(1000)))


def word_slots(df: DataFrame, keys: list[str], position: str, start: str, end: str, words: int = 2, seconds: float = 1.0, open_ended: bool = False) -> DataFrame:
    """Times of words without any, between the nearest words that have some: columns slot_start, slot_end and source.

    ``position`` counts from 0 without holes inside a key; a word has both times or neither.  The words of a gap get equal slots
    from the end of the word before to the start of the word after.  source: 'known', 'interpolated', or why not, with null times:
    'unknown_edge' (no word with times on one side), 'too_many_words', 'gap' (not over 0 and at most ``seconds``).
    ``open_ended`` sets no bounds, takes an empty gap as one of length 0 and goes beyond the edges ('extrapolated'): before the first known word in
    steps of 0.8 of its mean word time so far, after the last one in steps of 0.8 of its own time, 0.08 at least.
    """
    here = Window.partitionBy(*keys).orderBy(position)
    known = F.when(F.col(start).isNotNull() & F.col(end).isNotNull(), F.struct(F.col(position).cast("long").alias("p"), F.col(start).alias("s"), F.col(end).alias("e")))
    out = df.withColumn("_k", known)
    out = out.withColumn("_l", F.last("_k", ignorenulls=True).over(here.rowsBetween(Window.unboundedPreceding, 0)))
    out = out.withColumn("_r", F.first("_k", ignorenulls=True).over(here.rowsBetween(0, Window.unboundedFollowing)))
    at, l, r = F.col(position), lambda f: F.col(f"_l.{f}"), lambda f: F.col(f"_r.{f}")
    missing, gap = r("p") - l("p") - 1, r("s") - l("e")
    edge = F.col("_l").isNull() | F.col("_r").isNull()
    offset = at - l("p") - 1
    if open_ended:
        slot = F.greatest(F.lit(0.0), gap) / missing
        ahead = F.greatest(F.lit(0.08), (r("s") / F.greatest(F.lit(1), r("p"))) * 0.8)
        head = F.greatest(F.lit(0.0), r("s") - ahead * (r("p") - at))
        tail = F.greatest(F.lit(0.08), (l("e") - l("s")) * 0.8)
        first = F.when(F.col("_l").isNull(), head).when(F.col("_r").isNull(), l("e") + tail * offset).otherwise(l("e") + slot * offset)
        last = F.when(F.col("_l").isNull(), F.least(r("s"), head + ahead)).when(F.col("_r").isNull(), l("e") + tail * (offset + 1)).otherwise(l("e") + slot * (offset + 1))
        source = F.when(F.col("_k").isNotNull(), "known").when(F.col("_l").isNull() & F.col("_r").isNull(), "unknown_edge").when(edge, "extrapolated").otherwise("interpolated")
    else:
        slot = gap / missing
        first, last = l("e") + slot * offset, l("e") + slot * (offset + 1)
        source = F.when(F.col("_k").isNotNull(), "known").when(edge, "unknown_edge").when(missing > words, "too_many_words").when(~((gap > 0) & (gap <= seconds)), "gap").otherwise("interpolated")
    given = source.isin("interpolated", "extrapolated")
    out = out.withColumn("source", source)
    out = out.withColumn("slot_start", F.when(F.col("_k").isNotNull(), F.col(start)).when(given, first)).withColumn("slot_end", F.when(F.col("_k").isNotNull(), F.col(end)).when(given, last))
    return out.drop("_k", "_l", "_r")


def catalog_captions(cues: DataFrame, keys: list[str], place: str, text: str) -> DataFrame:
    """(keys, cue, block): one caption file an output (keys) from cues of its parts: times move on by the durations of the parts before.

    cues: keys, part_no, duration of the part, place, start and end inside it, text.  A cue ends with its part at the latest;
    one that is empty then is dropped, and the others are numbered over the whole output.
    """
    parts = cues.select(*keys, "part_no", "duration").distinct()
    moved = running_offset(parts, keys, [F.col("part_no")], "duration", "_at").select(*keys, "part_no", "_at")
    shown = cues.withColumn("end", F.least("end", "duration")).filter("end > start").join(moved, [*keys, "part_no"])
    cue = F.row_number().over(Window.partitionBy(*keys).orderBy("part_no", place)).cast("long")
    block = F.concat(F.col("cue").cast("string"), F.lit("\n"), clock(F.col("_at") + F.col("start")), F.lit(" --> "), clock(F.col("_at") + F.col("end")), F.lit("\n"), F.col(text))
    return shown.withColumn("cue", cue).select(*keys, "cue", block.alias("block"))


def compare_timelines(left: DataFrame, right: DataFrame, keys: list[str], tolerance: float) -> DataFrame:
    """(keys, status, start_delta, end_delta) of two timelines (keys, start, end): 'only_left', 'only_right', 'agrees' or 'differs' by more than ``tolerance`` at either end."""
    a = left.select(*keys, F.struct("start", "end").alias("_a"))
    b = right.select(*keys, F.struct("start", "end").alias("_b"))
    both = a.join(b, keys, "full")
    delta = lambda x: F.round(F.abs(F.col(f"_a.{x}") - F.col(f"_b.{x}")), 6)
    status = F.when(F.col("_a").isNull(), "only_right").when(F.col("_b").isNull(), "only_left").when(F.greatest(delta("start"), delta("end")) > tolerance, "differs").otherwise("agrees")
    return both.select(*keys, status.alias("status"), delta("start").alias("start_delta"), delta("end").alias("end_delta"))


def stamp(seconds: Column) -> Column:
    """H:MM:SS of a time, rounded down."""
    whole = F.floor(seconds).cast("long")
    return F.format_string("%d:%02d:%02d", F.floor(whole / 3600), F.pmod(F.floor(whole / 60), F.lit(60)).cast("long"), F.pmod(whole, F.lit(60)))


def catalog_metadata(outputs: DataFrame, chapters: DataFrame, kinds: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(key, kind, title, label, playlist, description) of outputs by kind.

    outputs: key, kind and the ``fields``; kinds: kind, title, label, playlist, about, in which each field's name in braces stands for its value (null: nothing);
    chapters: key, at (seconds), name.  The description is the ``about`` line, a blank line and one line a chapter in order of time, where there are any.
    An output of an unknown kind has null texts.
    """
    lines = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "name"))), lambda c: F.concat(stamp(c["at"]), F.lit(" "), c["name"])), "\n")
    listed = chapters.groupBy(key).agg(lines.alias("_lines"))  # the chapters of one output
    joined = outputs.join(F.broadcast(kinds), "kind", "left").join(listed, key, "left")  # a row a kind

    def filled(column: str) -> Column:
        text = F.col(column)
        for field in fields:
            text = F.replace(text, F.lit(f"{{{field}}}"), F.coalesce(F.col(field).cast("string"), F.lit("")))
        return text

    about = filled("about")
    description = F.when(F.col("_lines").isNotNull(), F.concat(about, F.lit("\n\n"), F.col("_lines"))).otherwise(about)
    return joined.select(key, "kind", *[filled(c).alias(c) for c in ("title", "label", "playlist")], description.alias("description"))
