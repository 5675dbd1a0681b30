"""Joins on intervals, quotes and exact counterparts, each kept an equi-join, and the glossary of terms."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def interval_overlap(left: DataFrame, right: DataFrame, keys: list[str], width: int) -> DataFrame:
    """Pairs whose half-open intervals overlap inside a key; both sides: keys, id, start, end (whole numbers).

    Each side goes to the buckets of ``width`` that it touches; a pair counts
    in the bucket of its later start only.  Empty intervals overlap nothing.
    """

    def dealt(df: DataFrame, side: str) -> DataFrame:
        named = df.filter(F.col("start") < F.col("end")).select(*keys, *[F.col(c).alias(f"{side}_{c}") for c in ("id", "start", "end")])
        touched = F.sequence(F.floor(F.col(f"{side}_start") / width), F.floor((F.col(f"{side}_end") - 1) / width))
        return named.withColumn("_bucket", F.explode(touched))

    pairs = dealt(left, "left").join(dealt(right, "right"), [*keys, "_bucket"])
    later = F.greatest("left_start", "right_start")
    meet = (F.col("left_start") < F.col("right_end")) & (F.col("right_start") < F.col("left_end"))
    return pairs.filter(meet & (F.floor(later / width) == F.col("_bucket"))).drop("_bucket")


def exactly_one(issues: DataFrame, findings: DataFrame, keys: list[str], found: str) -> DataFrame:
    """Issues with their only finding: columns status ('matched', 'missing', 'ambiguous') and ``found`` (null unless matched)."""
    counted = findings.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min(found).alias(found))
    joined = issues.join(counted, keys, "left")
    status = F.when(F.col("_n").isNull(), "missing").when(F.col("_n") > 1, "ambiguous").otherwise("matched")
    return joined.withColumn("status", status).withColumn(found, F.when(F.col("_n") == 1, F.col(found))).drop("_n")


def parallels(quotes: DataFrame, texts: DataFrame, coll: str, key: str, text: str, words: int, first: int = 8) -> DataFrame:
    """(quote_id, key): the ``first`` other texts of the collection that contain a quote of ``words`` words parted by single spaces.

    A quote's inner words stand whole in every text that contains it, so they
    are the key of an equi-join; containment is then confirmed on the text.
    quotes: coll, quote_id (the key of its own text), quote.
    """
    inner = words - 2
    asked = quotes.withColumn("_h", F.xxhash64(F.array_join(F.slice(F.split("quote", " "), 2, inner), " ")))
    split = texts.select(coll, key, F.split(text, " ").alias("_w")).filter(F.size("_w") >= inner)
    grams = F.transform(F.sequence(F.lit(1), F.size("_w") - inner + 1), lambda i: F.xxhash64(F.array_join(F.slice("_w", i, inner), " ")))
    spread = split.select(coll, key, F.explode(F.array_distinct(grams)).alias("_h"))
    met = spread.join(asked, [coll, "_h"]).filter(F.col(key) != F.col("quote_id")).select("quote_id", "quote", key)
    sure = met.join(texts.select(key, text), key).filter(F.contains(F.col(text), F.col("quote")))
    place = Window.partitionBy("quote_id").orderBy(key)
    return sure.withColumn("_k", F.row_number().over(place)).filter(F.col("_k") <= first).select("quote_id", key)


def glossary(terms: DataFrame, term: str, ref: str, first: int = 12) -> DataFrame:
    """(term, uses, refs, first_refs): uses, distinct references and the first few of them, with ', ...' where there are more.

    Pairs are counted before anything meets by term, and only ``first``
    references of a term are ever put into one list.
    """
    pairs = terms.groupBy(term, ref).agg(F.count(F.lit(1)).alias("_n"))
    totals = pairs.groupBy(term).agg(F.sum("_n").alias("uses"), F.count(F.lit(1)).alias("refs"))
    place = Window.partitionBy(term).orderBy(ref)
    few = pairs.withColumn("_k", F.row_number().over(place)).filter(F.col("_k") <= first).groupBy(term).agg(F.sort_array(F.collect_list(ref)).alias("_r"))
    shown = F.concat(F.array_join(F.col("_r").cast("array<string>"), ", "), F.when(F.col("refs") > first, ", ...").otherwise(""))
    return totals.join(few, term).select(term, "uses", "refs", shown.alias("first_refs"))


def concordance(occurrences: DataFrame, lemma: str, unit: str, ref: str, length: str, below: int = 30, first: int = 3) -> DataFrame:
    """(unit, lemma, df, outside, exemplar) of every lemma of a unit that fewer than ``below`` references have.

    ``outside`` holds the ``first`` references of other units (empty: only in this one), ``exemplar`` is the shortest of
    all those, the earlier of equals.  Frequent lemmas go before anything is joined, so a list has fewer than ``below`` entries.
    """
    places = occurrences.select(lemma, unit, ref, length).dropDuplicates([lemma, ref])
    few = places.groupBy(lemma).agg(F.count(F.lit(1)).alias("df")).filter(F.col("df") < below)
    listed = places.join(few, lemma).groupBy(lemma, "df").agg(F.sort_array(F.collect_list(F.struct(ref, length, unit))).alias("_all"))
    each = listed.select(lemma, "df", "_all", F.explode(F.array_distinct(F.col(f"_all.{unit}"))).alias(unit))
    other = each.withColumn("_o", F.filter("_all", lambda x: ~x[unit].eqNullSafe(F.col(unit))))
    shortest = F.array_min(F.transform("_o", lambda x: F.struct(x[length], x[ref])))
    return other.select(unit, lemma, "df", F.slice(F.col(f"_o.{ref}"), 1, first).alias("outside"), shortest[ref].alias("exemplar"))


def word_places(df: DataFrame, key: str, words: str, run: int) -> tuple[DataFrame, DataFrame]:
    """(key, at, word) and (key, at, gram): every word of a list, and every run of ``run`` words."""
    place = df.select(key, F.posexplode(words).alias("at", "word"))
    n = F.size(words)
    starts = F.when(n >= run, F.sequence(F.lit(0), n - run)).otherwise(F.array().cast("array<int>"))
    grams = F.transform(starts, lambda i: F.array_join(F.slice(words, i + 1, run), "\x1f"))
    return place, df.select(key, F.posexplode(grams).alias("at", "gram"))


def token_match(df: DataFrame, key: str, expected: str, observed: str, run: int = 3, near: float = 0.60) -> DataFrame:
    """(key, expected_index, observed_index, exact) of two word lists.

    Equal runs of ``run`` words are joined and grow to blocks along their
    diagonal.  A block that crosses a longer one (the first of equals) goes.  Every word on either side belongs to its longest
    block, and a pair stands where both words agree on it.  Where two neighbouring
    pairs are equally far apart on both sides, the words between them are
    paired one by one if their edit distance leaves ``near`` of the longer word.
    Null lists match nothing; words are strings or null, and nulls match nothing.
    """
    lists = df.select(key, F.coalesce(expected, F.array().cast("array<string>")).alias("_x"), F.coalesce(observed, F.array().cast("array<string>")).alias("_y"))
    xs, x_runs = word_places(lists, key, "_x", run)
    ys, y_runs = word_places(lists, key, "_y", run)
    met = x_runs.withColumnRenamed("at", "i").join(y_runs.withColumnRenamed("at", "j"), [key, "gram"]).select(key, "i", (F.col("j") - F.col("i")).alias("d"))
    line = Window.partitionBy(key, "d").orderBy("i")
    blocks = met.withColumn("_b", F.col("i") - F.row_number().over(line)).groupBy(key, "d", "_b").agg(F.min("i").alias("a"), (F.max("i") + run).alias("z"))
    blocks = blocks.withColumn("len", F.col("z") - F.col("a"))
    other = blocks.select(F.col(key).alias("_k"), *[F.col(c).alias(f"_{c}") for c in ("d", "a", "len")])
    crosses = (F.col("a") - F.col("_a")) * (F.col("a") + F.col("d") - F.col("_a") - F.col("_d")) < 0
    longer = F.struct("_len", -F.col("_a"), -F.col("_d")) > F.struct("len", -F.col("a"), -F.col("d"))
    blocks = blocks.join(other, (F.col(key) == F.col("_k")) & crosses & longer, "left_anti")  # the blocks of one unit are few
    cells = blocks.select(key, "d", "len", "a", F.explode(F.sequence(F.col("a"), F.col("z") - 1)).alias("i")).withColumn("j", F.col("i") + F.col("d"))
    rank = lambda side: F.row_number().over(Window.partitionBy(key, side).orderBy(F.desc("len"), "a", "d"))
    exact = cells.withColumns({"_r": rank("i"), "_s": rank("j")}).filter("_r = 1 and _s = 1").select(key, "i", "j")
    ends = lists.select(key, F.explode(F.array(F.struct(F.lit(-1).alias("i"), F.lit(-1).alias("j")), F.struct(F.size("_x").alias("i"), F.size("_y").alias("j")))).alias("e")).select(key, "e.i", "e.j")
    order = Window.partitionBy(key).orderBy("i", "j")
    gaps = exact.union(ends).withColumns({"i0": F.lag("i").over(order), "j0": F.lag("j").over(order)})
    gaps = gaps.filter((F.col("i") - F.col("i0") == F.col("j") - F.col("j0")) & (F.col("i") - F.col("i0") > 1))
    between = gaps.select(key, F.explode(F.sequence(F.col("i0") + 1, F.col("i") - 1)).alias("i"), (F.col("j0") - F.col("i0")).alias("d")).withColumn("j", F.col("i") + F.col("d"))
    paired = between.join(xs.select(key, F.col("at").alias("i"), F.col("word").alias("x")), [key, "i"]).join(ys.select(key, F.col("at").alias("j"), F.col("word").alias("y")), [key, "j"])
    longest = F.greatest(F.length("x"), F.length("y"))
    close = paired.filter((longest > 0) & (F.levenshtein("x", "y") <= (1 - near) * longest)).select(key, "i", "j", (F.col("x") == F.col("y")).alias("exact"))
    out = exact.withColumn("exact", F.lit(True)).unionByName(close)
    return out.select(key, F.col("i").cast("long").alias("expected_index"), F.col("j").cast("long").alias("observed_index"), "exact")


def longest_block(a: list, b: list, alo: int, ahi: int, blo: int, bhi: int) -> tuple[int, int, int]:
    """(i, j, size) of the longest run that a[alo:ahi] and b[blo:bhi] share, the first in ``a`` of equal ones, then the first in ``b``; in linear time.

    A suffix automaton of the part of ``b`` is walked along the part of ``a``.
    """
    step: list[dict] = [{}]
    link, size, first = [-1], [0], [0]  # suffix link, longest run of a state, and where that run first ends
    last = 0
    for at in range(blo, bhi):
        item, new = b[at], len(step)
        step.append({})
        link.append(0)
        size.append(size[last] + 1)
        first.append(at)
        p, last = last, new
        while p >= 0 and item not in step[p]:
            step[p][item] = new
            p = link[p]
        if p < 0:
            continue
        q = step[p][item]
        if size[q] == size[p] + 1:
            link[new] = q
            continue
        copy = len(step)
        step.append(dict(step[q]))
        link.append(link[q])
        size.append(size[p] + 1)
        first.append(first[q])
        while p >= 0 and step[p].get(item) == q:
            step[p][item] = copy
            p = link[p]
        link[q] = link[new] = copy
    state = run = 0
    best = (alo, blo, 0)
    for at in range(alo, ahi):
        while state and a[at] not in step[state]:
            state = link[state]
            run = size[state]
        if a[at] in step[state]:
            state, run = step[state][a[at]], run + 1
            if run > best[2]:
                best = (at - run + 1, first[state] - run + 1, run)
    return best


def matching_blocks(a: list, b: list) -> list[tuple[int, int, int]]:
    """The longest shared run, and those of what lies left and right of it, in order; neighbours joined."""
    open_, found = [(0, len(a), 0, len(b))], []
    while open_:
        alo, ahi, blo, bhi = open_.pop()
        if alo < ahi and blo < bhi:
            i, j, n = longest_block(a, b, alo, ahi, blo, bhi)
            if n:
                found.append((i, j, n))
                open_ += [(alo, i, blo, j), (i + n, ahi, j + n, bhi)]
    out: list[tuple[int, int, int]] = []
    for i, j, n in sorted(found):
        if out and out[-1][0] + out[-1][2] == i and out[-1][1] + out[-1][2] == j:
            i, j, n = out[-1][0], out[-1][1], out.pop()[2] + n
        out.append((i, j, n))
    return out


def alike(x: str, y: str, near: float) -> bool:
    """Whether the shared runs of two words have ``near`` of the characters of both."""
    both = len(x) + len(y)
    if not both or 2 * min(len(x), len(y)) < near * both:
        return not both
    return 2 * sum(n for *_, n in matching_blocks(list(x), list(y))) >= near * both


def block_match(df: DataFrame, key: str, expected: str, observed: str, near: float = 0.60) -> DataFrame:
    """(key, expected_index, observed_index, exact) of two word lists, by longest shared runs first, single equal words included.

    Between two runs, stretches of equal length on both sides are paired word by
    word where the words are alike.  A row's lists are matched in its task, so lists are those of packed units, not of whole
    collections; nothing is shuffled.  Null lists match nothing; null words match nothing.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: list[tuple] = []
            for k, x, y in zip(*(b.column(c).to_pylist() for c in (key, expected, observed))):
                a = [w if w is not None else (0, i) for i, w in enumerate(x or [])]  # a null equals nothing
                o = [w if w is not None else (1, i) for i, w in enumerate(y or [])]
                i0 = j0 = 0
                for i, j, n in [*matching_blocks(a, o), (len(a), len(o), 0)]:
                    if i - i0 == j - j0:
                        rows += [(k, i0 + d, j0 + d, False) for d in range(i - i0) if isinstance(a[i0 + d], str) and isinstance(o[j0 + d], str) and alike(a[i0 + d], o[j0 + d], near)]
                    rows += [(k, i + d, j + d, True) for d in range(n)]
                    i0, j0 = i + n, j + n
            cols = list(zip(*rows)) if rows else [()] * 4
            kinds = (b.schema.field(key).type, pa.int64(), pa.int64(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=[key, "expected_index", "observed_index", "exact"])

    return df.select(key, expected, observed).mapInArrow(run, f"`{key}` {df.schema[key].dataType.simpleString()}, expected_index long, observed_index long, exact boolean")
