"""File sinks: editions in canonical order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_edition_json(items: DataFrame, path: str, columns: list[str]) -> None:
    """One JSON object per item, ranged and sorted by (coll, seq); file names follow that order."""
    ordered = items.repartitionByRange("coll", "seq").sortWithinPartitions("coll", "seq")
    ordered.select(*columns).write.mode("overwrite").json(path)


def write_edition_text(items: DataFrame, path: str, text: str = "text") -> None:
    """One line ``ref TAB text`` per item under a folder of its collection; line ends inside a text become spaces, a null text a placeholder."""
    flat = F.regexp_replace(F.coalesce(F.col(text), F.concat(F.lit("[UNTRANSLATED "), "ref", F.lit("]"))), r"[\r\n]+", " ")
    ordered = items.repartitionByRange("coll", "seq").sortWithinPartitions("coll", "seq")
    ordered.select("coll", F.concat("ref", F.lit("\t"), flat).alias("value")).write.mode("overwrite").partitionBy("coll").text(path)
