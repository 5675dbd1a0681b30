"""Edge cases of single operators."""

from pyspark.sql import functions as F

from corpusloom.functions.ordinals import global_ordinal
from corpusloom.operators import address, folds, resolve, rules


def test_parse_ref_is_strict(spark):
    df = spark.createDataFrame([("2:255",), ("2:",), ("1234:1",), (None,)], "ref string")
    got = df.select(address.parse_ref(F.col("ref")).alias("r")).select("r.coll", "r.seq").collect()
    assert [tuple(r) for r in got] == [(2, 255), (None, None), (None, None), (None, None)]


def test_greedy_packing_of_oversized_rows(spark):
    df = spark.createDataFrame([("a", i, c) for i, c in enumerate([5, 100, 5, 5])], "k string, i long, c long")
    got = folds.fold_units(df, ["k"], [F.col("i")], "c", folds.greedy(10, 20)).orderBy("i").collect()
    assert [r["unit"] for r in got] == [0, 1, 2, 2]


def test_fold_of_an_empty_table(spark):
    df = spark.createDataFrame([], "k string, i long, c long")
    assert folds.fold_units(df, ["k"], [F.col("i")], "c", folds.greedy(10, 20)).collect() == []


def test_guarded_edit_statuses(spark):
    df = spark.createDataFrame([("aba", "b", "x"), ("abab", "b", "x"), ("a", "b", "x")], "t string, b string, a string")
    got = resolve.guarded_edit(df, "t", "b", "a").select("status", "new_text").collect()
    assert [tuple(r) for r in got] == [("applied", "axa"), ("ambiguous", "abab"), ("missing", "a")]


def test_rewrite_keeps_case(spark):
    text, edits = rules.rewrite(F.col("t"), [("with", "with", "beside")])
    got = spark.createDataFrame([("With WITH with within",)], "t string").select(text.alias("t"), edits.alias("e")).first()
    assert got["t"] == "Beside BESIDE beside within" and got["e"] == ["with: 3"]


def test_global_ordinal(spark):
    got = global_ordinal(spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v")).repartition(5), ["v"], "n").collect()
    assert all(r["n"] == r["v"] + 1 for r in got) and len(got) == 1000
