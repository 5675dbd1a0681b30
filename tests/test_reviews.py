"""Import decisions, contracts, scalar functions, ledgers and the entry's guard on small fixtures."""

import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import texts as T
from corpusloom.operators import review as W
from corpusloom.streaming import intake
from corpusloom.streaming.runner import drain


def test_scalar_functions(spark):
    df = spark.createDataFrame([("e\u0301 A\u200db!", '"say"', "2024-01-02T03:04:05+02:00"), (None, None, None), ("", "'x", "2024-01-02 03:04")], "t string, q string, z string")
    got = df.select(T.normal_form(F.col("t")).alias("n"), T.without_marks(F.col("t")).alias("m"), T.slug(F.col("t")).alias("s"), T.unquoted(F.col("q")).alias("u"), T.zoned_time(F.col("z")).cast("string").alias("z"), T.localized_digits(F.lit("a19"), "\u06f0").alias("d")).collect()
    assert [r["n"] for r in got] == ["\u00e9 A\u200db!", None, ""]
    assert [r["m"] for r in got] == ["e Ab!", None, ""] and got[0]["s"] == "e-a-b" and got[0]["d"] == "a\u06f1\u06f9"
    assert [r["u"] for r in got] == ["say", None, "'x"] and [r["z"] for r in got] == ["2024-01-02 01:04:05", None, None]


def test_reimport_decisions(spark):
    rows = [("a", 1, "x"), ("b", 2, "y"), ("c", 3, None), ("gone", 4, "z")]
    old = spark.createDataFrame(rows, "s string, k long, t string")
    new = spark.createDataFrame([("a", 1, "x"), ("b", 2, "Y"), ("c", 3, "w"), ("fresh", 5, "q")], old.schema)
    deps = spark.createDataFrame([("b",), ("b",), ("a",)], "s string")
    got = {r["s"]: r["action"] for r in W.reimport_decision(old, new, deps, "s", "k", "t").collect()}
    assert got == {"a": "noop", "b": "reject", "c": "replace", "gone": "replace", "fresh": "replace"}


def test_response_forms(spark):
    bodies = ["[]", '{"translations": [{"ref": "1", "text": "t", "terms": [{"term": "a"}]}]}', 'Sure: [{"ref": "1", "text": ""}] ok', "none", None, '[{"ref": "1", "text": "t"}, {"ref": "1", "text": "t"}]']
    answers = spark.createDataFrame(list(enumerate(bodies)), "k long, body string")
    wanted = answers.select("k", F.lit("1").alias("ref"))
    got = sorted((r["k"], r["problem"]) for r in W.entry_issues(W.response_entries(answers, "k"), wanted, "k").collect())
    assert got == [(0, "missing"), (1, "incomplete_term"), (2, "empty"), (3, "missing"), (3, "unreadable"), (4, "missing"), (4, "unreadable"), (5, "duplicate")]


def test_passages_name_missing_and_repeated_references(spark):
    release = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c"), (2, 1, "d")], "coll long, seq long, text string")
    asked = spark.createDataFrame([("x", 1, 1, 2), ("y", 1, 2, 3), ("z", 2, 1, 1)], "id string, coll long, first long, last long")
    got = {r["id"]: (r["passage"], r["missing"], r["repeated"]) for r in W.passage_text(asked, release, "id").collect()}
    assert got == {"x": ("a b", 0, 0), "y": (None, 1, 0), "z": (None, 0, 1)}


def test_middle_values_and_paired_rates(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("a", 4.0, None), ("a", None, 5.0), ("a", 2.0, 2.0), ("a", 9.0, 0.0), ("b", None, 1.0)], "k string, v double, w double")
    got = {r["k"]: r for r in W.cohort_metrics(df, ["k"], "v", "w", 4).collect()}
    a, b = got["a"], got["b"]
    assert (a["known"], a["unknown"], a["lower"], a["upper"], a["median"], a["paired_rate"], a["enough"]) == (4, 1, 2.0, 4.0, 3.0, 3.0, True)
    assert (b["known"], b["lower"], b["median"], b["paired_rate"], b["enough"]) == (0, None, None, None, False)


def test_ledger_and_intake_know_nulls(spark, tmp_path):
    rows = [(1, 0, "reserve", 60.0, None), (1, 1, "reserve", 50.0, None), (1, 2, "reserve", None, "x"), (1, 3, "settle", 40.0, None), (1, 4, "settle", 30.0, None), (1, 5, "release", 20.0, None), (1, 6, "reserve", float("inf"), None), (1, 7, "odd", 1.0, None)]
    spark.createDataFrame(rows, "a long, n long, what string, v double, p string").write.parquet(f"{tmp_path}/rows.parquet")
    got = sorted(map(tuple, drain(spark, f"{tmp_path}/rows.parquet", lambda s: intake.settled_ledger(s, "a", "n", "what", "v", 100)).collect()))
    assert got == [(0, "accepted", 0, 60), (1, "over_ceiling", 0, 60), (2, "invalid", 0, 60), (3, "accepted", 40, 20), (4, "not_held", 40, 20), (5, "accepted", 40, 0), (6, "invalid", 40, 0), (7, "invalid", 40, 0)]
    told = [r["outcome"] for r in sorted(drain(spark, f"{tmp_path}/rows.parquet", lambda s: intake.intake(s, ["a"], "n", "p")).collect())]
    assert told == ["stored", "noop", "conflict", *["noop"] * 5]


@pytest.mark.parametrize("missing", ["ahocorasick", "corpusloom.llm", "corpus_pipeline"])
def test_entry_without_the_corpus_operators(missing):
    root = Path(__file__).parent.parent
    code = f"import sys; sys.modules[{missing!r}] = None; import __spark_entry__ as e; q = e.queries(); assert 'gat2_run_gate' in q and 'pipeline' not in q and set(e.oracle_sql()) <= set(q)"
    assert subprocess.run([sys.executable, "-c", code], cwd=root, timeout=120).returncode == 0
