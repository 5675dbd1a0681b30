"""File sources on small files."""

from corpusloom.sources import files


def test_items_from_xml(spark, tmp_path):
    (tmp_path / "s.xml").write_text('<corpus><collection index="2" name="b"><item index="1" text="x" marker="m"/><item index="3" text=" "/></collection><collection index="1" name="a"><item index="1" text="y"/></collection></corpus>')
    got = files.read_items_xml(spark, str(tmp_path / "s.xml"))
    assert sorted((r["global_no"], r["ref"], r["coll_name"], r["text"].strip(), r["marker"]) for r in got.collect()) == [(1, "1:1", "a", "y", None), (2, "2:1", "b", "x", "m"), (3, "2:3", "b", "", None)]
    assert sorted(map(tuple, files.import_problems(got).collect())) == [("2:3", "blank_text"), ("2:3", "order")]


def test_tokens_from_tsv(spark, tmp_path):
    (tmp_path / "t.tsv").write_text("# head\n\n1:2:3:4\tform\tN\tROOT:abc|LEM:x\n1:2:3:5\tother\tV\nbroken\tline\n")
    got = sorted(files.read_tokens_tsv(spark, str(tmp_path / "t.tsv")).collect())
    assert [(r["coll"], r["segment"], r["form"], r["pos"], r["features"]) for r in got] == [(1, 4, "form", "N", {"ROOT": "abc", "LEM": "x"}), (1, 5, "other", "V", None)]


def test_artifacts_leave_out_failed_and_unreadable(spark, tmp_path):
    for name, body in {"a.json": '{"unit": "u1",\n "n": 1}', "b-FAILED.json": '{"unit": "u2", "n": 2}', "c.json": "{nonsense"}.items():
        (tmp_path / name).write_text(body)
    got = files.read_artifacts(spark, str(tmp_path), "unit string, n long").collect()
    assert [(r["unit"], r["n"], r["file"]) for r in got] == [("u1", 1, "a.json")]
