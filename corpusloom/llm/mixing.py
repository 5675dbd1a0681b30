"""Mixing sources to target weights by cube-method balanced sampling.

Every source gets a target number of words; a document enters the mix
``floor(target / source_size)`` times and once more with the fractional rest
as inclusion probability.  The cube method turns these fractions into 0 or 1:
three units at a time, the fractions move along the null-space of the two
constraints (documents and words), so both totals stay as they were, until a
unit lands on 0 or 1.  Blocks of bounded size are flown independently; what
stays fractional (two units a block at most) goes to the next level, and the
last two units of a source are landed by the choice nearest to its word total.
Large documents fly first, so that the landing is left with small ones.

A document is known by doc_id, source and a hash of its text; rows equal in all
of them are numbered, so they too are spread over the blocks, and which numbers
are taken does not depend on where the rows lie.

Defined edge cases: a null or empty text has size 0 and may be taken (0 words);
a null source is a source of its own and sorts last; repeated rows, and rows
with null or repeated doc_ids, are documents of their own; an empty table gives
an empty result; other columns are ignored by ``mix`` and kept, whatever their
names, by ``apply_mix``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import free_names, materialize, table, with_row_number

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MAX_REPEAT = 2.0
BLOCK = 4096
EPS = 1e-9


def word_sizes(docs: DataFrame, *carry: str) -> DataFrame:
    """(doc_id, source, size, fp, columns to carry): size counts runs other than space and \\x09-\\x0D, fp is a hash of the text."""
    text = F.col("text").cast("string")
    size = F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), size.alias("size"), F.xxhash64(text).alias("fp"), *carry)


def numbered_copies(sizes: DataFrame) -> DataFrame:
    """The written ``sizes`` with unit: a hash of doc_id, source, fp and a number that is different among equal rows.

    Equal rows are counted first; only those that have equals are numbered, inside their partition and then from the counts of
    the partitions before it, so that no group of equals is gathered in one task.
    """
    same = ["doc_id", "source", "fp"]
    marked = sizes.withColumn("unit", F.xxhash64(*same))
    groups = marked.groupBy("unit").agg(F.count(F.lit(1)).alias("_c")).filter("_c > 1").select("unit")
    single = marked.join(groups, "unit", "left_anti")
    several = materialize(marked.join(groups, "unit", "left_semi").withColumn("_at", F.monotonically_increasing_id()), "equals")
    placed = several.withColumn("_p", F.shiftright("_at", 20))  # runs of a million rows of a partition
    here = placed.groupBy("unit", "_p").agg(F.count(F.lit(1)).alias("_c"))
    before = here.withColumn("_o", F.coalesce(F.sum("_c").over(Window.partitionBy("unit").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_c")
    local = placed.withColumn("_k", F.row_number().over(Window.partitionBy("unit", "_p").orderBy("_at"))).join(before, ["unit", "_p"])
    counted = local.withColumn("unit", F.xxhash64("unit", F.col("_o") + F.col("_k")))
    return single.unionByName(counted.select(*single.columns))


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, cap: float = MAX_REPEAT) -> DataFrame:
    """(source, source_size, n_docs, target): weights repeat over sources in code-point order, nulls last.

    The level of the water-filling is found from one-row sums; sources stay distributed.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    numbered, _ = with_row_number(per, [F.col("source").asc_nulls_last()], "_i", "sources")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("_i") % len(weights) + 1).cast("int"))
    src = numbered.withColumn("weight", w)
    limit = F.col("source_size") * F.lit(cap)
    total, all_w = src.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0.0))).first()
    want = share * float(total)
    level = want / all_w if all_w else 0.0
    while True:
        over = F.lit(level) * F.col("weight") > limit
        full, open_w = src.agg(F.coalesce(F.sum(F.when(over, limit)), F.lit(0.0)), F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0.0))).first()
        new = (want - full) / open_w if open_w else level
        if new <= level:
            break
        level = new
    return src.withColumn("target", F.least(F.lit(level) * F.col("weight"), limit)).drop("_i", "weight")


def fly(p: np.ndarray, z: np.ndarray, seed: int) -> np.ndarray:
    """Flight phase over one block: returns fractions of which at most two are not 0 or 1."""
    p = p.astype(float).tolist()
    z = z.astype(float).tolist()
    draw = np.random.RandomState(seed).random_sample(len(p) + 4).tolist()
    active: list[int] = []
    turn = 0
    for i in range(len(p)):
        if EPS < p[i] < 1 - EPS:
            active.append(i)
        else:
            p[i] = float(round(p[i]))
        while len(active) == 3:
            i0, i1, i2 = active
            u = (z[i2] - z[i1], z[i0] - z[i2], z[i1] - z[i0])
            if not any(u):
                u = (1.0, -1.0, 0.0)
            up = down = float("inf")
            for k, d in zip(active, u):
                if d > 0:
                    up, down = min(up, (1 - p[k]) / d), min(down, p[k] / d)
                elif d < 0:
                    up, down = min(up, -p[k] / d), min(down, (p[k] - 1) / d)
            step = up if draw[turn % len(draw)] * (up + down) < down else -down
            turn += 1
            rest = []
            for k, d in zip(active, u):
                p[k] += step * d
                if p[k] <= EPS or p[k] >= 1 - EPS:
                    p[k] = float(round(p[k]))
                else:
                    rest.append(k)
            if len(rest) == 3:  # rounding kept all three inside: land the nearest
                k = min(rest, key=lambda j: min(p[j], 1 - p[j]))
                p[k] = float(round(p[k]))
                rest.remove(k)
            active = rest
    return np.array(p)


def land(p: np.ndarray, z: np.ndarray) -> np.ndarray:
    """Round the last (at most two) fractions to the choice nearest to the word total, then to the document total."""
    open_ = [i for i in range(len(p)) if 0 < p[i] < 1]
    best: tuple = ()
    for code in range(1 << len(open_)):
        bits = [code >> k & 1 for k in range(len(open_))]
        words = abs(sum((b - p[i]) * z[i] for b, i in zip(bits, open_)))
        docs = abs(sum(b - p[i] for b, i in zip(bits, open_)))
        if not best or (words, docs, code) < best[0]:
            best = ((words, docs, code), bits)
    out = p.copy()
    for i, b in zip(open_, best[1]):
        out[i] = b
    return out


def mix(docs: DataFrame, seed: int = 7, block: int = BLOCK, carry: tuple[str, ...] = (), **targets: float) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken, and the long columns to carry."""
    written = materialize(word_sizes(docs, *carry), "sizes")
    src = source_targets(written, **targets)
    sizes = numbered_copies(written)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    small = F.broadcast(src) if src.count() <= 10_000 else src
    rows = sizes.join(small, sizes.source.eqNullSafe(src.source)).drop(src.source)
    base = F.floor(ratio + F.lit(EPS)).cast("int")
    rows = rows.withColumn("base", base).withColumn("p", F.greatest(F.lit(0.0), ratio - F.col("base"))).withColumn("left", F.col("n_docs"))
    columns = ["doc_id", "source", "size", "unit", "source_size", "target", "base", "p", *carry]
    schema = "doc_id long, source string, size long, unit long, source_size long, target double, base int, p double, " + "".join(f"{c} long, " for c in carry) + "left long, last boolean"

    def run_block(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["size", "_h"], ascending=[False, True], kind="stable").reset_index(drop=True)
        blocks = int(pdf["_blocks"].iloc[0])
        p, z = fly(pdf["p"].to_numpy(), pdf["size"].to_numpy(), seed + int(pdf["_block"].iloc[0])), pdf["size"].to_numpy()
        pdf["p"] = land(p, z) if blocks == 1 else p
        pdf["left"], pdf["last"] = 2 * blocks, blocks == 1
        return pdf[[*columns, "left", "last"]]

    done: list[DataFrame] = []
    level = 0
    while True:
        n = F.ceil(F.col("left") / F.lit(block)).cast("long")
        keyed = rows.withColumn("_h", F.xxhash64("unit", F.lit(seed))).withColumn("_blocks", F.greatest(n, F.lit(1)))
        keyed = keyed.withColumn("_block", F.pmod(F.xxhash64("_h", F.lit(level)), F.col("_blocks")))
        flown = materialize(keyed.groupBy("source", "_block").applyInPandas(run_block, schema), f"cube{level}")
        landed = F.col("last") | (F.col("p") == 0) | (F.col("p") == 1)
        done.append(flown.filter(landed))
        rows = flown.filter(~landed)
        level += 1
        if rows.isEmpty():
            break
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    copies = (F.col("base") + F.round("p").cast("int")).alias("copies")
    return out.select("doc_id", "source", "size", "source_size", "target", copies, *carry).withColumn("taken", F.col("copies") * F.col("size"))


def apply_mix(docs: DataFrame, **options: float) -> DataFrame:
    """The documents of the mix, each as often as the mix takes it; columns as given."""
    row, times = free_names(docs, "_row", "_copies")
    numbered = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "rows")  # doc_ids may be null or repeated
    copies = mix(numbered, carry=(row,), **options).select(row, F.col("copies").alias(times))
    joined = numbered.join(copies.filter(F.col(times) > 0), row)
    taken = joined.withColumn(times, F.explode(F.sequence(F.lit(1), F.col(times))))
    return taken.drop(row, times)


def op9_cube_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies")


QUERIES = {"op9_cube_mixing": op9_cube_mixing}
ORACLES: dict[str, str] = {}
