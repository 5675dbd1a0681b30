"""File sources: addressed XML, token TSV and folders of JSON artifacts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.functions.ordinals import global_ordinal

def read_items_xml(spark: SparkSession, path: str, row_tag: str = "collection", item_tag: str = "item", number: str = "index", name: str = "name", text: str = "text", marker: str = "marker") -> DataFrame:
    """(global_no, coll, coll_name, seq, ref, text, marker): items of collections, numbered from 1 in canonical order.

    Collections are elements ``row_tag`` with the attributes ``number`` and ``name``, items are elements ``item_tag`` in them
    with the attributes ``number``, ``text`` and ``marker``.
    """
    schema = f"`_{number}` long, `_{name}` string, `{item_tag}` array<struct<`_{number}`:long,`_{text}`:string,`_{marker}`:string>>"
    rows = spark.read.format("xml").option("rowTag", row_tag).schema(schema).load(path)
    each = rows.select(F.col(f"_{number}").alias("coll"), F.col(f"_{name}").alias("coll_name"), F.explode(item_tag).alias("a"))
    seq = F.col("a")[f"_{number}"]
    items = each.select("coll", "coll_name", seq.alias("seq"), F.concat("coll", F.lit(":"), seq).alias("ref"), F.col("a")[f"_{text}"].alias("text"), F.col("a")[f"_{marker}"].alias("marker"))
    return global_ordinal(items, ["coll", "seq"], "global_no")


def import_problems(items: DataFrame) -> DataFrame:
    """(ref, problem) of items that break the import contract: 'blank_text', or 'order' where a position is not the one before plus 1."""
    before = F.lag("seq", 1, 0).over(Window.partitionBy("coll").orderBy("seq"))
    blank = F.trim(F.coalesce("text", F.lit(""))) == ""
    found = F.array_compact(F.array(F.when(blank, "blank_text"), F.when(F.col("seq") != F.col("_b") + 1, "order")))
    return items.withColumn("_b", before).select("ref", F.explode(found).alias("problem"))


def read_tokens_tsv(spark: SparkSession, path: str) -> DataFrame:
    """(coll, seq, word, segment, form, pos, features): lines of ``a:b:c:d``, form, pos and features ``K:V`` parted by bars.

    Blank lines, comments and lines without a four-part address are left out.
    """
    cells = F.split("value", "\t")
    lines = spark.read.text(path).filter(F.col("value").rlike(r"^\d+:\d+:\d+:\d+\t")).select(cells.alias("c"))
    at = lambda i: F.split(F.col("c")[0], ":")[i].cast("long")
    features = F.when(F.size("c") > 3, F.str_to_map(F.col("c")[3], F.lit(r"\|"), F.lit(":")))
    cell = lambda i: F.when(F.size("c") > i, F.col("c")[i])
    return lines.select(at(0).alias("coll"), at(1).alias("seq"), at(2).alias("word"), at(3).alias("segment"), cell(1).alias("form"), cell(2).alias("pos"), features.alias("features"))


def read_artifacts(spark: SparkSession, path: str, schema: str, failed: str = "FAILED") -> DataFrame:
    """The readable JSON documents of a folder with their file name; files named ``failed`` and unreadable ones are left out."""
    rows = spark.read.schema(f"{schema}, _corrupt string").option("columnNameOfCorruptRecord", "_corrupt").json(path, multiLine=True)
    named = rows.withColumn("file", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1))
    return named.filter(F.col("_corrupt").isNull() & ~F.contains("file", F.lit(failed))).drop("_corrupt")


def artifact_manifest(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(name, bytes, digest) of every file under ``path``: its name below it, its size and the SHA-256 of what is in it.

    Each file is one row of the binary source, so an artifact must fit into one (2 GB); the source leaves out files without content; order by name where an order is wanted.
    """
    found = spark.read.format("binaryFile").load(f"{path.rstrip('/')}/{pattern}")
    inside = F.split("path", F.lit(path.rstrip("/").rsplit("/", 1)[-1] + "/"), 2)[1]
    return found.select(inside.alias("name"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("digest"))


def manifest_differences(recorded: DataFrame, actual: DataFrame) -> DataFrame:
    """(name, status): 'missing', 'unexpected', 'changed' or 'ok', of a recorded manifest against the files as they are."""
    now = actual.select("name", F.struct("bytes", "digest").alias("_now"))
    both = recorded.select("name", F.struct("bytes", "digest").alias("_was")).join(now, "name", "full")
    status = F.when(F.col("_now").isNull(), "missing").when(F.col("_was").isNull(), "unexpected").when(F.col("_now") != F.col("_was"), "changed").otherwise("ok")
    return both.select("name", status.alias("status"))
