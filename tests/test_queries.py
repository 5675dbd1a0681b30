"""Every registered query against its DuckDB oracle, and invariance to the number of shuffle partitions."""

import math
import os

import duckdb
import pytest

from corpusloom import plans

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return "null" if math.isnan(v) else f"{v:.9g}"
    if isinstance(v, bool) or v is None:
        return str(v).lower().replace("none", "null")
    return f"{float(v):.9g}" if isinstance(v, int) else str(v)


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in data)


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    con.sql("set timezone='UTC'")
    for t in TABLES:
        p = f"{sf}/{t}.parquet"
        con.sql(f"create view {t} as from '{p + '/*.parquet' if os.path.isdir(p) else p}'")
    return con


@pytest.mark.parametrize("name", sorted(plans.ORACLES))
def test_matches_oracle(spark, duck, sf, name):
    got = plans.QUERIES[name](spark, sf)
    want = duck.sql(plans.ORACLES[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got.columns, [tuple(r) for r in got.collect()]) == rows(want.columns, want.fetchall())


@pytest.mark.parametrize("partitions", ["1", "7", "64"])
def test_folds_do_not_depend_on_partitions(spark, sf, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    want = sorted(map(tuple, plans.QUERIES["win1_greedy_packing"](spark, sf).collect()))
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        assert sorted(map(tuple, plans.QUERIES["win1_greedy_packing"](spark, sf).collect())) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
