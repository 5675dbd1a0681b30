"""Splitting texts by words, and digests that prove what was split or partitioned still is the whole, in order.

``word_digest`` is a polynomial over the words of one row; digests of pieces
combine by shifting each past the words that follow it, so the regrouped text is never
gathered.  ``merkle`` hashes ordered rows by position in nodes of a fixed
number of children, so the digest does not depend on how they are partitioned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.ordinals import keyed_ordinal

#: Two primes below 2**31 and a base, for products that stay inside 64 bits.
PRIMES = (2147483629, 2147483587)
BASE = 1_000_003


def words_of(text: Column) -> Column:
    """Words apart by blanks, tabs and line ends; none of a null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"[ \t\r\n]+"), lambda w: w != "")


def word_wrap(words: Column, limit: int) -> Column:
    """The words as lines of at most ``limit`` characters, single blanks between; a longer word is a line of its own. Inside the row, no shuffle."""
    start = F.struct(F.array().cast("array<string>").alias("lines"), F.lit("").alias("line"))

    def step(s: Column, w: Column) -> Column:
        put = lambda lines, line: F.struct(lines.alias("lines"), line.alias("line"))
        full = F.length(s["line"]) + 1 + F.length(w) > limit
        return F.when(s["line"] == "", put(s["lines"], w)).when(full, put(F.array_append(s["lines"], s["line"]), w)).otherwise(put(s["lines"], F.concat(s["line"], F.lit(" "), w)))

    return F.aggregate(words, start, step, lambda s: F.when(s["line"] == "", s["lines"]).otherwise(F.array_append(s["lines"], s["line"])))


def clause_lines(text: Column, clause: str, merged: int, long: int, wrapped: int) -> Column:
    """Pieces that match ``clause``, joined again while they fit into ``merged`` characters; one that is left of a text
    over ``long`` characters is wrapped by words at ``wrapped``."""
    pieces = F.filter(F.transform(F.regexp_extract_all(text, F.lit(clause), F.lit(0)), lambda p: F.trim(p)), lambda p: p != "")
    lines = word_wrap(pieces, merged)
    return F.when((F.size(lines) == 1) & (F.length(text) > long), word_wrap(words_of(text), wrapped)).otherwise(lines)


def split_failed(lines: DataFrame, leaf: str, place: str, text: str, limit: int) -> DataFrame:
    """(leaf, index, place, piece, problem): the lines of failed leaves cut by words into pieces of at most ``limit`` characters.

    A leaf of one line that stays one piece is halved after half of its words, rounded up.  Problems, with no piece:
    'empty_line', and 'irreducible' for a leaf of one word.
    """
    per = lines.groupBy(leaf).agg(F.count(F.lit(1)).alias("_lines"))
    known = lines.select(leaf, place, words_of(F.col(text)).alias("_w")).join(per, leaf)
    wrapped = word_wrap(F.col("_w"), limit)
    half = F.ceil(F.size("_w") / 2).cast("int")
    halves = F.array(F.array_join(F.slice("_w", F.lit(1), half), " "), F.array_join(F.slice("_w", half + 1, F.size("_w")), " "))
    alone = (F.col("_lines") == 1) & (F.size(wrapped) == 1)
    problem = F.when(F.size("_w") == 0, "empty_line").when(alone & (F.size("_w") < 2), "irreducible")
    judged = known.select(leaf, place, problem.alias("problem"), F.when(alone, halves).otherwise(wrapped).alias("_p"))
    bad = judged.filter("problem is not null").select(leaf, F.lit(None).cast("int").alias("index"), place, F.lit(None).cast("string").alias("piece"), "problem")
    cut = judged.filter("problem is null").select(leaf, place, F.posexplode("_p").alias("_k", "piece"))
    index = F.row_number().over(Window.partitionBy(leaf).orderBy(place, "_k"))  # a leaf is a bounded unit
    return cut.select(leaf, index.alias("index"), place, "piece", F.lit(None).cast("string").alias("problem")).unionByName(bad)


def word_digest(words: Column) -> Column:
    """struct(n, a, b): number of words and two polynomials over their hashes, by Horner's rule inside the row."""

    def fold(prime: int) -> Column:
        return F.aggregate(words, F.lit(0).cast("long"), lambda h, w: F.pmod(h * BASE + F.pmod(F.xxhash64(w), F.lit(prime)), F.lit(prime)))

    return F.struct(F.size(words).cast("long").alias("n"), fold(PRIMES[0]).alias("a"), fold(PRIMES[1]).alias("b"))


def _power(exponent: Column, prime: int) -> Column:
    """BASE ** exponent modulo a prime, by repeated squaring."""
    one = F.lit(1).cast("long")
    start = F.struct(one.alias("r"), F.lit(BASE).cast("long").alias("b"), exponent.cast("long").alias("e"))

    def step(s: Column, _: Column) -> Column:
        odd = F.pmod(s["e"], F.lit(2)) == 1
        return F.struct(F.when(odd, F.pmod(s["r"] * s["b"], F.lit(prime))).otherwise(s["r"]).alias("r"), F.pmod(s["b"] * s["b"], F.lit(prime)).alias("b"), F.shiftright(s["e"], 1).alias("e"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(40)), start, step, lambda s: s["r"])


def joined_digest(pieces: DataFrame, keys: list[str], order: str, digest: str) -> DataFrame:
    """(keys, n, a, b): the digest of the pieces' words one after another, from the pieces' own digests."""
    after = Window.partitionBy(*keys).orderBy(F.desc(order)).rowsBetween(Window.unboundedPreceding, -1)
    shifted = pieces.select(*keys, F.col(f"{digest}.*"), F.coalesce(F.sum(F.col(f"{digest}.n")).over(after), F.lit(0)).alias("_after"))
    summed = [F.pmod(F.sum(F.pmod(F.col(c) * _power(F.col("_after"), p), F.lit(p))), F.lit(p)).alias(c) for c, p in zip("ab", PRIMES)]
    return shifted.groupBy(*keys).agg(F.sum("n").alias("n"), *summed)


def word_coverage(wholes: DataFrame, whole_order: str, whole_text: str, pieces: DataFrame, piece_order: str, piece_text: str, key: str) -> DataFrame:
    """(key, words, piece_words, covered): whether the pieces' words, in order, are those of the whole; both sides one row or more a key."""
    told = lambda df, order, text: joined_digest(df.select(key, order, word_digest(words_of(F.col(text))).alias("_d")), [key], order, "_d")
    a, b = told(wholes, whole_order, whole_text), told(pieces, piece_order, piece_text)
    b = b.select(key, F.col("n").alias("_n"), F.col("a").alias("_a"), F.col("b").alias("_b"))
    both = a.join(b, key, "full")
    same = F.struct("n", "a", "b").eqNullSafe(F.struct("_n", "_a", "_b"))
    return both.select(key, F.coalesce("n", F.lit(0)).alias("words"), F.coalesce("_n", F.lit(0)).alias("piece_words"), same.alias("covered"))


def merkle(rows: DataFrame, keys: list[str], order: list[str], line: Column, fan: int = 1024) -> DataFrame:
    """(keys, rows, digest): SHA-256 of the ordered rows of each key, or of the whole table where ``keys`` is empty.

    Leaves are the digests of the lines; each node is that of the digests of ``fan`` neighbours by position, one
    after another; a node alone on its level is the root.  Positions are those along ``order`` inside the key, however the
    rows are partitioned; a node is built from ``fan`` digests and no more.
    """
    placed = keyed_ordinal(rows.withColumn("_digest", F.sha2(line.cast("binary"), 256)), keys, order, "_at").select(*keys, (F.col("_at") - 1).alias("_at"), "_digest")
    sizes = placed.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    most = sizes.agg(F.max("rows")).first()[0] or 0
    level = placed.join(sizes, keys) if keys else placed.crossJoin(sizes)  # one row
    level, wide = level.withColumn("_nodes", F.col("rows")), 1
    while wide < most:
        listed = F.array_sort(F.collect_list(F.struct("_at", "_digest")))
        whole = F.sha2(F.array_join(F.transform(listed, lambda x: x["_digest"]), "").cast("binary"), 256)
        merged = level.groupBy(*keys, "rows", "_nodes", F.floor(F.col("_at") / fan).alias("_up")).agg(F.when(F.col("_nodes") == 1, F.min("_digest")).otherwise(whole).alias("_digest"))
        level = merged.select(*keys, "rows", F.ceil(F.col("_nodes") / fan).alias("_nodes"), F.col("_up").alias("_at"), "_digest")
        wide *= fan
    return level.select(*keys, "rows", F.col("_digest").alias("digest"))
