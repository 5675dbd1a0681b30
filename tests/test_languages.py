"""The queries on documents of every language, on a small folder with several languages and none."""

import pytest

from corpusloom import plans
from corpusloom.operators import matching, resolve

TEXTS = [
    (1, "The same  line", "en"),
    (2, "The same line", "fr"),
    (3, " The same\tline", None),
    (4, "Été à la plage, un idiot", "fr"),
    (5, "Été à  la plage, un idiot", None),
    (6, "idioté idiot_ with withé With, WITH with", "fr"),
    (7, "İİİ, he IS THE one", "de"),
]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("languages")
    spark.createDataFrame([(i, t, lang, "s", len(t)) for i, t, lang in TEXTS], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    return str(path)


def test_groups_cross_languages_and_hold_rows_without_one(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    groups = {}
    for r in resolve.duplicate_groups(docs, "doc_id", "text").collect():
        groups.setdefault(r["group_id"], set()).add(r["doc_id"])
    assert sorted(map(sorted, groups.values())) == [[1, 2, 3], [4, 5]]
    assert plans.QUERIES["con9_group_choice"](spark, folder).count() == 2
    assert plans.QUERIES["agg6_invariance"](spark, folder).first()["present"] == 3  # the rendering of document 5 is absent


def test_terms_and_rewrites_know_letters_of_other_languages(spark, folder):
    terms = dict(map(tuple, plans.QUERIES["prj5_banned_terms"](spark, folder).collect()))
    assert {k for k, v in terms.items() if v} == {4, 5} and len(terms) == len(TEXTS)
    new = {r["doc_id"]: r for r in plans.QUERIES["prj10_case_preserving_rewrite"](spark, folder).collect()}
    assert new[6]["text"] == "idioté idiot_ beside withé Beside, BESIDE beside" and new[6]["edits"] == "with: 4"
    assert [tuple(r) for r in plans.QUERIES["prj9_phrase_leads"](spark, folder).collect()] == [(7, "is the", "IS THE")]
    assert [tuple(r) for r in plans.QUERIES["agg10_edit_histogram"](spark, folder).collect()] == [("with", 1)]


def test_words_are_not_cut_at_accents(spark, folder):
    df = dict(map(tuple, plans.QUERIES["agg9_lemma_document_frequency"](spark, folder).collect()))
    assert df["été"] == 2 and df["same"] == 3 and "t" not in df
    assert {r["term"]: r["first_refs"] for r in plans.QUERIES["agg7_glossary"](spark, folder).collect()}["été"] == "4, 5"
    assert ("plage", 2, "4,5") in {(r["lemma"], r["df"], r["first_refs"]) for r in plans.QUERIES["res10_concordance"](spark, folder).collect()}
    for name in ("gat15_word_sequence", "res3_accept_gated_overlay"):
        assert plans.QUERIES[name](spark, folder).count() == len(TEXTS)


def test_concordance_of_a_unit_has_lemmas_of_one_document_and_leaves_its_own_out(spark):
    rows = [("rare", 0, 1, 9), ("both", 0, 1, 9), ("both", 0, 2, 3), ("both", 1, 8, 7), ("both", 1, 9, 5), ("both", 2, 16, 5), ("both", 2, 17, 8)]
    rows += [("often", i // 8, i, 4) for i in range(30)]
    got = matching.concordance(spark.createDataFrame(rows, "lemma string, unit long, ref long, len int"), "lemma", "unit", "ref", "len").collect()
    assert {(r["unit"], r["lemma"], r["df"], tuple(r["outside"]), r["exemplar"]) for r in got} == {
        (0, "rare", 1, (), None), (0, "both", 6, (8, 9, 16), 9), (1, "both", 6, (1, 2, 16), 2), (2, "both", 6, (1, 2, 8), 2)
    }
