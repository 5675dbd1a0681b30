"""Registration of queries with their oracle SQL, and the fixture views they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Callable[[Callable[[str], DataFrame]], DataFrame]], Query]:
    """Register f(read) as a query; read(table) gives a table of the folder."""

    def register(f: Callable[[Callable[[str], DataFrame]], DataFrame]) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(lambda table: spark.read.parquet(f"{sf_dir}/{table}.parquet"))

        QUERIES[name] = run
        if oracle:
            ORACLES[name] = oracle
        return run

    return register


def items(read: Callable[[str], DataFrame]) -> DataFrame:
    """Conversations as addressed items: coll, seq, ref, text."""
    c = read("conversations").select(F.col("conv_id").alias("coll"), (F.col("turn") + 1).alias("seq"), "role", "text")
    return c.withColumn("ref", F.concat("coll", F.lit(":"), "seq"))


#: The same in SQL, as the head of a WITH clause.
ITEMS = "items AS (SELECT conv_id AS coll, turn + 1 AS seq, role, text, conv_id || ':' || (turn + 1) AS ref FROM conversations)"
#: A total order of lineitem.
LINE_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
