"""Guarded edits applied twice against their SQL, on short texts in which an edit brings back what it looks for."""

import random

from test_times import same_as_sql


def test_digest_and_source_are_of_the_first_time(spark, tmp_path):
    r = random.Random(4)
    texts = {k: "".join(r.choice("aaéEDIT🦆 ") for _ in range(r.randrange(40))) for k in range(600)}
    texts |= {2: "E", 5: "a" * 23, 70: "x" * 20 + " " + "y" * 5, 8: "", 10: " ", 11: None, 13: None, 105: "x" * 19 + "é " + "y"}
    docs = spark.createDataFrame([(k, t, "en", "s", len(t or "")) for k, t in texts.items()], "doc_id long, text string, lang string, source string, n_chars long")
    got = {x["doc_id"]: x for x in same_as_sql(spark, tmp_path, "res7_adjudicated_twice", "documents", docs)}
    assert {k for k in (2, 5, 70, 105) if got[k]["second"] == "changed"} == {2, 5, 70, 105}
    assert {x["second"] for x in got.values()} == {"changed", "already_applied", "before_guard", "after_without_provenance", "retained", "retain_guard", "unknown_action", "missing_text"}
