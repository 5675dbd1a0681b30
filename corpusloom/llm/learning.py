"""A bounded, reproducible sample of labelled texts for fitting the two classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRAIN_BYTES = 48 << 20


def split_of(doc_id: Column, parts: int) -> Column:
    """crc32 of the doc_id as text, modulo ``parts``; null ids count as 0."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(parts)), F.lit(0)).cast("int")


def training_texts(docs: DataFrame, labels: DataFrame, label: str, usable: Column, rows: int, total: int = TRAIN_BYTES) -> tuple[list[str], list[int]]:
    """At most ``rows`` labelled rows of at most ``total`` bytes together, chosen by a hash of doc_id; for fitting only.

    Chosen texts come whole.  A text that would pass ``total`` is left for the next of the order.  ``usable`` says which
    doc_ids may be learnt from.  Rows with a null text or label are left out; rows equal in doc_id and text count once;
    a doc_id with labels that disagree is learnt as one row for each of them.
    """
    marks = labels.filter(usable & F.col(label).isNotNull()).select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("_y"))
    marks = F.broadcast(marks.orderBy(F.xxhash64("_id"), "_id", "_y").limit(rows))  # bounded by ``rows``
    texts = docs.filter(F.col("text").isNotNull()).select(F.col("doc_id").alias("_id"), F.col("text").cast("string").alias("_t"))
    known = texts.join(marks, "_id").select("_id", "_y", F.xxhash64("_t").alias("_fp"), F.octet_length("_t").alias("_n"), "_t")
    sizes = known.select("_id", "_y", "_fp", "_n").distinct().orderBy(F.xxhash64("_id"), "_id", "_fp", "_y").limit(rows).collect()
    chosen, used = [], 0
    for r in sizes:
        if used + r["_n"] <= total:
            used += r["_n"]
            chosen.append((r["_id"], r["_y"], r["_fp"]))
    if not chosen:
        return [], []
    spark = docs.sparkSession
    wanted = F.broadcast(spark.createDataFrame(chosen, f"_id {docs.schema['doc_id'].dataType.simpleString()}, _y int, _fp long"))
    got = known.join(wanted, ["_id", "_y", "_fp"]).dropDuplicates(["_id", "_y", "_fp"]).select("_id", "_y", "_t").collect()
    got = sorted(got, key=lambda r: (r["_id"], r["_y"], r["_t"]))
    return [r["_t"] for r in got], [r["_y"] for r in got]
