"""Digests, sections, kept tables, packing, matching and guarded edits on small rows, against plain Python."""

import difflib
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import ordinals
from corpusloom.operators import coverage, evals, folds, matching, resolve, review, rules, sections, timeline
from corpusloom.sources import files, versions
from corpusloom.streaming import intake


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


# --- words and digests


def test_wrap_is_greedy(spark):
    r = random.Random(1)
    texts = [" ".join("x" * r.randrange(1, 14) for _ in range(r.randrange(40))) for _ in range(50)] + ["", None, "  a\n\tb ", "y" * 90]
    got = spark.createDataFrame(list(enumerate(texts)), "k long, t string").select("k", coverage.word_wrap(coverage.words_of(F.col("t")), 30).alias("w"))
    assert not any("Exchange" in x for x in got._jdf.queryExecution().executedPlan().toString().splitlines())
    for k, lines in got.collect():
        want, line = [], ""
        for w in (texts[k] or "").split():
            if line and len(line) + 1 + len(w) > 30:
                want.append(line)
                line = w
            else:
                line = f"{line} {w}".strip()
        assert lines == want + ([line] if line else [])


def test_failed_leaves(spark):
    lines = [("many", 1, "a b c"), ("many", 2, "d " * 30), ("one", 1, "p q r s t"), ("word", 1, "solitary"), ("blank", 1, " "), ("blank", 2, "x")]
    got = rows(coverage.split_failed(spark.createDataFrame(lines, "leaf string, place long, text string"), "leaf", "place", "text", 20))
    assert ("one", 1, 1, "p q r", None) in got and ("one", 2, 1, "s t", None) in got
    assert ("word", None, 1, None, "irreducible") in got and ("blank", None, 1, None, "empty_line") in got
    assert [r[3] for r in got if r[0] == "many" and r[2] == 1] == ["a b c"]


def test_digest_of_pieces_is_that_of_the_whole(spark):
    r = random.Random(2)
    whole, pieces = [], []
    for k in range(30):
        words = [f"w{r.randrange(5)}" for _ in range(r.randrange(1, 40))]
        whole.append((k, 0, " ".join(words)))
        cut = sorted(r.sample(range(len(words) + 1), min(3, len(words) + 1)))
        parts = [words[a:b] for a, b in zip([0, *cut], [*cut, len(words)])]
        if k % 3 == 1 and len(words) > 1:
            i = next(i for i, p in enumerate(parts) if p)
            parts[i] = parts[i][:-1] + ["other"]
        if k % 3 == 2:
            parts = parts[::-1]
        pieces += [(k, i, " ".join(p)) for i, p in enumerate(parts)]
    schema = "k long, n long, t string"
    got = {x["k"]: x["covered"] for x in coverage.word_coverage(spark.createDataFrame(whole, schema), "n", "t", spark.createDataFrame(pieces, schema).repartition(5), "n", "t", "k").collect()}
    for k, _, t in whole:
        assert got[k] == (" ".join(p for kk, _, p in sorted(pieces) if kk == k and p).split() == t.split())


def test_merkle_digest_depends_on_order_and_rows_only(spark):
    base = [(i // 40, i, f"t{i % 7}") for i in range(100)]
    make = lambda data, parts: coverage.merkle(spark.createDataFrame(data, "c long, i long, t string").repartition(parts), [], ["c", "i"], F.col("t"), 4).collect()
    want = make(base, 1)
    assert want[0]["rows"] == 100 and make(base[::-1], 7) == want
    twins = [(0, 0, "x"), (0, 0, "x")]
    assert make(twins, 1) != make([(0, 0, "y"), (0, 0, "y")], 1)
    changed = [*base[:50], (base[50][0], base[50][1], "other"), *base[51:]]
    assert make(changed, 3) != want and make(base[1:], 3) != want and make([], 1) == []
    per = coverage.merkle(spark.createDataFrame(base, "c long, i long, t string"), ["c"], ["i"], F.col("t"), 4)
    alone = coverage.merkle(spark.createDataFrame(base[:40], "c long, i long, t string"), ["c"], ["i"], F.col("t"), 4)
    assert rows(per)[0] == rows(alone)[0]  # of a collection's own rows only


def test_fingerprint_tells_repeated_rows(spark):
    deps = spark.createDataFrame([("none",)], "s string")
    act = lambda a, b: {r["s"]: r["action"] for r in review.reimport_decision(spark.createDataFrame(a, "s string, k long, t string"), spark.createDataFrame(b, "s string, k long, t string"), deps, "s", "k", "t").collect()}
    assert act([("a", 1, "x")] * 2, [("a", 1, "y")] * 2) == {"a": "replace"}
    assert act([("a", 1, "x"), ("a", 2, None)], [("a", 2, None), ("a", 1, "x")]) == {"a": "noop"}
    assert act([("a", 1, "")], [("a", 1, None)]) == act([("a", 1, "1:x")], [("a", 11, ":x")]) == {"a": "replace"}


def test_ordinals_inside_a_key(spark):
    data = [(k, v) for k, n in ((None, 5), ("hot", 300), ("x", 1)) for v in [7] * (n // 2) + list(range(n - n // 2))]
    got = rows(ordinals.keyed_ordinal(spark.createDataFrame(data, "k string, v long").repartition(6), ["k"], ["v"], "at"))
    for k in (None, "hot", "x"):
        own = sorted((at, v) for kk, v, at in got if kk == k)
        assert [a for a, _ in own] == list(range(1, len(own) + 1)) and [v for _, v in own] == sorted(v for _, v in own)


def test_ranks_of_one_hot_key(spark):
    values = [random.Random(4).randrange(50) for _ in range(501)]
    df = spark.createDataFrame([("one", v) for v in values], "k string, v long").repartition(8)
    assert evals.nearest_rank(df, ["k"], "v", 0.95).first()["p"] == sorted(values)[round(0.95 * 500)]
    sample = evals.even_sample(df, ["k"], ["v"], 5)
    assert sorted(r["v"] for r in sample.collect()) == [sorted(values)[round(i * 500 / 4)] for i in range(5)]


# --- sections


def test_sections_of_any_length(spark):
    parts = [(1, 1, 4, 4), (2, 5, 5, 1), (3, 8, 30, 23), (4, 20, 25, 6), (5, 60, 50, 0)]
    sec = spark.createDataFrame(parts, "section long, first long, last long, expected long")
    items = spark.createDataFrame([(i, i % 3) for i in [*range(1, 41), 3]], "at long, section long").repartition(5)

    def section(i):
        began = [s for s in parts if s[1] <= i and s[1] <= s[2]]
        return began[-1][0] if began and i <= began[-1][2] else None

    found = sections.assign_sections(items, sec, "at")
    assert rows(found.select("at", "section")) == sorted([(i, section(i)) for i in [*range(1, 41), 3]], key=str)
    assert rows(sections.section_audit(found, sec).select("section", "problem")) == sorted([(1, "count"), (2, "ok"), (3, "count"), (3, "gap"), (4, "overlap"), (5, "empty_range"), (5, "gap")], key=str)


# --- tables kept under a path


def test_replacing_scopes_leaves_other_files(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "s string, n long"
    spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], schema).write.partitionBy("s").parquet(path)
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "t" / "s=c").iterdir()}
    got = versions.replace_scopes(path, spark.createDataFrame([("a", 9), ("a", 10)], schema), "s", ["a", "b"])
    assert rows(got) == [("a", 10), ("a", 9), ("c", 3)]
    assert {p: p.stat().st_mtime_ns for p in (tmp_path / "t" / "s=c").iterdir()} == before
    with pytest.raises(ValueError):
        versions.replace_scopes(path, spark.createDataFrame([("c", 1)], schema), "s", ["a"])
    assert rows(versions.replace_scopes(path, spark.createDataFrame([], schema), "s", ["a"])) == [("c", 3)]


def test_a_version_holds_only_when_published(spark, tmp_path):
    store = versions.VersionedTable(spark, str(tmp_path / "v"))
    schema = "k long, t string"
    none = spark.createDataFrame([], schema)
    one, two = spark.createDataFrame([(1, "x")], schema), spark.createDataFrame([(1, "y"), (2, None)], schema)
    assert store.current() is None and versions.reimport(store, one, one, "k", "t") == "replace"
    staged = store.stage(two)  # killed here: nothing has changed
    assert rows(versions.VersionedTable(spark, str(tmp_path / "v")).current()) == [(1, "x")]
    assert versions.reimport(store, one, one, "k", "t") == "noop" and versions.reimport(store, two, one, "k", "t") == "reject"
    base = store.pointers()[-1]
    store.publish(staged, "r", base)
    with pytest.raises(RuntimeError):  # another writer built on the same version
        store.publish(staged, "r", base)
    assert rows(store.current()) == [(1, "y"), (2, None)] and versions.reimport(store, none, none, "k", "t") == "replace"


def test_file_manifest(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "a.bin").write_bytes(b"\x00\xff")
    (tmp_path / "d" / "b.bin").write_bytes(b"xyz")
    (tmp_path / "d" / "empty.bin").write_bytes(b"")
    found = files.artifact_manifest(spark, str(tmp_path / "d"))
    assert [(r["name"], r["bytes"]) for r in found.orderBy("name").collect()] == [("a.bin", 2), ("b.bin", 3)]
    recorded = spark.createDataFrame([("a.bin", 2, "other"), ("gone", 1, "x")], "name string, bytes long, digest string")
    assert rows(files.manifest_differences(recorded, found)) == [("a.bin", "changed"), ("b.bin", "unexpected"), ("gone", "missing")]


# --- matching


def test_blocks_are_those_of_a_plain_search(spark):
    r = random.Random(5)
    pairs = []
    for k in range(120):
        x = [r.choice("abcd") * r.choice([1, 3]) for _ in range(r.randrange(25))]
        y = [w if r.random() < 0.7 else r.choice(["a", "bx", "dddx"]) for w in x if r.random() < 0.9]
        pairs.append((k, x, y))
    pairs += [(900, None, ["a"]), (901, [None, "a"], [None, "a"])]
    got = {}
    for k, i, j, exact in matching.block_match(spark.createDataFrame(pairs, "k long, x array<string>, y array<string>"), "k", "x", "y").collect():
        got.setdefault(k, set()).add((i, j, exact))
    for k, x, y in pairs[:-2]:
        want = set()
        for tag, i1, i2, j1, j2 in difflib.SequenceMatcher(None, x, y, autojunk=False).get_opcodes():
            if tag == "equal":
                want |= {(i1 + d, j1 + d, True) for d in range(i2 - i1)}
            elif tag == "replace" and i2 - i1 == j2 - j1:
                want |= {(i1 + d, j1 + d, False) for d in range(i2 - i1) if difflib.SequenceMatcher(None, x[i1 + d], y[j1 + d], autojunk=False).ratio() >= 0.6}
        assert got.get(k, set()) == want, (x, y)
    assert 900 not in got and got[901] == {(1, 1, True)}


def test_many_equal_words_end():
    assert matching.matching_blocks(["a"] * 100_000, ["a"] * 99_000) == [(0, 0, 99_000)]


# --- rules, groups and edits


def test_terms_and_replacements_are_literal(spark):
    df = spark.createDataFrame([("axb a.b cost $5 c\\d",)], "t string")
    assert df.select(rules.banned_terms(F.col("t"), ["a.b", "("])).first()[0] == "a.b"
    text, edits = rules.rewrite(F.col("t"), [("x", "cost", "$9\\")])
    assert tuple(df.select(text, F.array_join(edits, ",")).first()) == ("axb a.b $9\\ $5 c\\d", "x: 1")


def test_groups_keep_case_and_join_forms(spark):
    texts = ["Polish", "polish", "café  x", " café x ", "café x", None]
    got = resolve.duplicate_groups(spark.createDataFrame(list(enumerate(texts)), "k long, t string"), "k", "t")
    assert sorted(r["k"] for r in got.collect() if r["group_id"]) == [2, 3, 4]


def test_edits_again_and_under_another_table(spark):
    texts = spark.createDataFrame([(1, "say red now"), (2, "red and red"), (3, "keep me"), (4, "has blue")], "k long, text string").withColumn("provenance", F.lit(None).cast(resolve.PROVENANCE))
    edit = lambda k, what: (k, what, "red", "blue", "keep", "c", "why")
    edits = spark.createDataFrame([edit(1, "change"), edit(2, "change"), edit(3, "retain"), edit(4, "change"), edit(5, "retain")], "k long, action string, before string, after string, expected string, category string, rationale string")
    first = resolve.adjudicate(texts, edits, "k", "s1")
    assert {r["k"]: r["status"] for r in first.collect()} == {1: "changed", 2: "before_guard", 3: "retained", 4: "after_without_provenance", 5: "missing_text"}
    again = lambda stamp: {r["k"]: r["status"] for r in resolve.adjudicate(first.select("k", "text", "provenance"), edits, "k", stamp).collect()}
    assert again("s1")[1] == "already_applied" and again("s2")[1] == "after_without_provenance"
    source = {r["k"]: r["provenance"]["source"] for r in resolve.adjudicate(first.select("k", "text", "provenance"), edits, "k", "s1").collect() if r["provenance"]}
    assert source == {1: "say red now", 3: "keep me"}


# --- packing and times


def test_bounded_packing_refuses_whole_keys(spark):
    data = [("a", 1, i, 10) for i in range(7)] + [("a", 2, i, 10) for i in range(2)] + [("b", 1, 0, 99), ("b", 1, 1, 5)]
    packed, refused = folds.pack_bounded(spark.createDataFrame(data, "k string, s long, i long, c long"), ["k"], ["s"], [F.col("i")], "c", 32, 50)
    assert sorted((r["s"], r["i"], r["unit"]) for r in packed.collect()) == [(1, 0, 0), (1, 1, 0), (1, 2, 0), (1, 3, 1), (1, 4, 1), (1, 5, 1), (1, 6, 2), (2, 0, 3), (2, 1, 3)]
    assert [r["k"] for r in refused.collect()] == ["b"]


def test_slots(spark):
    word = lambda p, s=None, e=None: (1, p, s, e)
    data = [word(0, 0.0, 0.2), word(1), word(2), word(3, 0.8, 0.9), word(4), word(5), word(6), word(7, 1.5, 1.6), word(8), word(9, 9.0, 9.1), word(10)]
    got = timeline.word_slots(spark.createDataFrame(data, "k long, p long, s double, e double"), ["k"], "p", "s", "e")
    by = {r["p"]: (r["source"], None if r["slot_start"] is None else round(r["slot_start"], 6), None if r["slot_end"] is None else round(r["slot_end"], 6)) for r in got.collect()}
    assert by[1] == ("interpolated", 0.2, 0.5) and by[2] == ("interpolated", 0.5, 0.8)
    assert by[5] == ("too_many_words", None, None) and by[8] == ("gap", None, None) and by[10] == ("unknown_edge", None, None)


# --- ledgers


def test_amounts_are_exact(spark, tmp_path):
    data = [(1, i, "reserve", "0.9") for i in range(4)] + [(1, 4, "settle", "0.9"), (1, 5, "reserve", "NaN"), (1, 6, "reserve", "-1"), (1, 7, "release", "0.1")]
    spark.createDataFrame(data, "a long, n long, what string, x string").coalesce(1).write.parquet(str(tmp_path / "in"))
    from corpusloom.streaming.runner import drain

    out = drain(spark, str(tmp_path / "in"), lambda s: intake.settled_ledger(s, "a", "n", "what", "x", 1))
    got = [(r["status"], r["spent"], r["held"]) for r in out.orderBy("n").collect()]
    zero, part = Decimal(0), Decimal("0.9")
    assert got == [("accepted", zero, part)] + [("over_ceiling", zero, part)] * 3 + [("accepted", part, zero), ("invalid", part, zero), ("invalid", part, zero), ("not_held", part, zero)]


def test_large_payloads_are_told_apart(spark, tmp_path):
    spark.createDataFrame([(1, 0, 2**53), (1, 1, 2**53 + 1), (1, 2, None), (1, 3, 2**53)], "k long, n long, v long").coalesce(1).write.parquet(str(tmp_path / "in"))
    from corpusloom.streaming.runner import drain

    out = drain(spark, str(tmp_path / "in"), lambda s: intake.intake(s, ["k"], "n", "v"))
    assert [r["outcome"] for r in out.orderBy("n").collect()] == ["stored", "conflict", "conflict", "noop"]
