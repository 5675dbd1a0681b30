"""The corpus pipeline: five filtering and mixing stages over ``documents``, each written and read again.

Documents that the toxicity lexicon rejects go; of near-duplicates (five-word
shingles, Jaccard 0.8 or more) the smallest doc_id stays; documents
contaminated by the benchmark go; sources are mixed to their target weights
(documents are repeated or left out as whole texts); every row of the mix gets
its shard and slot.

Defined edge cases, each judged by row: null, empty and wordless texts are
scored by the lexicon's curve at 0, are near-duplicates of nothing, hit no
benchmark window, have size 0 in the mix and get a shard; repeated rows are one
group of near-duplicates, repeated or null doc_ids of different texts are not;
equal texts of several rows are told apart by row wherever one of them stays.
Without labels of both kinds nothing is toxic; an empty benchmark contaminates
nothing; an empty table gives an empty result.  Extra columns stay, whatever
their names; ``shard`` and ``slot`` are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import decontaminate, mixing, neardup, sharding, toxicity
from corpusloom.llm.common import materialize, table


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels")))


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.drop_near_duplicates(docs, width=5, percent=80)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.apply_mix(docs)


def shard_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(docs, [F.col("doc_id").asc_nulls_first(), F.xxhash64("text").asc()])


STAGES = [
    ("toxicity", remove_toxic),
    ("near-duplicates", remove_near_duplicates),
    ("decontamination", remove_benchmark),
    ("mixing", mix_sources),
    ("sharding", shard_documents),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs, f"stage{i}")
    return docs


#: The classifier and the balanced sample have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None
