"""Edge cases of the matching and contract operators."""

from pyspark.sql import functions as F

from corpusloom.operators import contracts, matching


def intervals(spark, rows):
    return spark.createDataFrame(rows, "k string, id long, start long, end long")


def test_overlap_across_buckets_counts_once(spark):
    left = intervals(spark, [("a", 1, 0, 100), ("a", 2, 5, 5), ("b", 3, 0, 9), (None, 4, 0, 9)])
    right = intervals(spark, [("a", 7, 3, 95), ("a", 8, 100, 110), ("b", 9, 8, 20)])
    got = matching.interval_overlap(left, right, ["k"], 10).select("left_id", "right_id").collect()
    assert sorted(map(tuple, got)) == [(1, 7), (3, 9)]


def test_exactly_one(spark):
    issues = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    found = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3)], "k string, f long")
    got = matching.exactly_one(issues, found, ["k"], "f").orderBy("k").select("k", "status", "f").collect()
    assert [tuple(r) for r in got] == [("a", "matched", 1), ("b", "ambiguous", None), ("c", "missing", None)]


def test_parallels_match_inside_words_at_the_ends(spark):
    texts = spark.createDataFrame([("s", 1, "one two three"), ("s", 2, "xone two threes"), ("s", 3, "one twos three"), ("t", 4, "one two three"), ("s", 5, None), ("s", 6, "")], "c string, id long, t string")
    quotes = spark.createDataFrame([("s", 1, "one two three")], "c string, quote_id long, quote string")
    assert [tuple(r) for r in matching.parallels(quotes, texts, "c", "id", "t", 3).collect()] == [(1, 2)]


def test_glossary_cuts_long_lists(spark):
    terms = spark.createDataFrame([("x", i % 3) for i in range(7)] + [("y", 5)], "term string, ref long")
    got = {r["term"]: tuple(r)[1:] for r in matching.glossary(terms, "term", "ref", 2).collect()}
    assert got == {"x": (7, 3, "0, 1, ..."), "y": (1, 1, "5")}


def test_responses_that_cannot_be_read(spark):
    bodies = spark.createDataFrame([(1, '```json\n[{"ref": "a", "text": "t"}]\n```'), (2, "sorry"), (3, None), (4, "[]")], "k long, body string")
    expected = spark.createDataFrame([(k, "a") for k in (1, 2, 3, 4)], "k long, ref string")
    got = sorted((r["k"], r["problem"]) for r in contracts.response_issues(bodies, expected, "k").collect())
    assert got == [(2, "missing"), (2, "unreadable"), (3, "missing"), (3, "unreadable"), (4, "missing")]


def test_null_checks_fail_and_empty_quotes_are_not_grounded(spark):
    df = spark.createDataFrame([("A  b c", "a B", None), ("abc", " ", True)], "t string, q string, ok boolean")
    assert [r[0] for r in df.select(contracts.grounded(F.col("t"), F.col("q"))).collect()] == [True, False]
    assert [r[0] for r in df.select(contracts.first_failure([("ok", F.col("ok"))])).collect()] == ["ok", "pass"]
