"""The text and group queries on documents of every language, those without one included.

Words are runs of letters and marks of any script, and a term counts as a word only where no letter, mark, digit or
underscore touches it; the oracles say the same without look-around, which DuckDB's expressions lack.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import functions as F

from corpusloom.functions.storage import written
from corpusloom.operators import contracts as C
from corpusloom.operators import matching as M
from corpusloom.operators import resolve as V
from corpusloom.operators import rules as R
from corpusloom.plans.base import query
from corpusloom.plans.texts import RENDERED, TERMS

LEMMA = r"[\p{L}\p{M}]+"
RUN = r"[\p{L}\p{M}\p{N}_]+"
GROUPS = r"h AS (SELECT doc_id, text, sha256(trim(regexp_replace(nfc_normalize(text), '[\s\x0B\x{85}\p{Z}\x1C-\x1F]+', ' ', 'g'))) AS g FROM documents)"


def _groups(read):
    return V.duplicate_groups(read("documents"), "doc_id", "text")


def _lemmas(read):
    return read("documents").select("doc_id", F.explode(_words()).alias("lemma"))


def _words():
    return F.regexp_extract_all(F.lower("text"), F.lit(LEMMA), F.lit(0))


def _distinct_lemmas(read):
    """One row per lemma and document; repeats inside a text go before anything is exploded."""
    return read("documents").select("doc_id", F.explode(F.array_distinct(_words())).alias("lemma"))


@query("prj5_banned_terms", f"SELECT doc_id, coalesce(list_aggregate(list_sort(list_distinct(list_filter(regexp_extract_all(lower(text), '{RUN}'), lambda x: x IN ('idiot', 'moron', 'scum', 'trash')))), 'string_agg', ','), '') AS terms FROM documents")
def banned(read):
    terms = R.banned_terms(F.col("text"), TERMS, R.WORD_EDGES)
    return read("documents").select("doc_id", F.coalesce(terms, F.lit("")).alias("terms"))


@query("prj9_phrase_leads", "SELECT doc_id, phrase, substr(text, strpos(lower(text), phrase), length(phrase)) AS found FROM documents, (VALUES ('is the'), ('of that'), ('and with')) p(phrase) WHERE contains(lower(text), phrase)")
def leads(read):
    return R.phrase_leads(read("documents"), "doc_id", "text", ["is the", "of that", "and with"])


def _twice(text: str, old: str, new: str) -> str:
    """A whole-word replacement in SQL: neighbours share their separator, so a second pass takes every other one."""
    for _ in range(2):
        text = rf"regexp_replace({text}, '(^|[^\p{{L}}\p{{M}}\p{{N}}_]){old}($|[^\p{{L}}\p{{M}}\p{{N}}_])', '\1{new}\2', 'g')"
    return text


@query("prj10_case_preserving_rewrite", f"""WITH d AS (SELECT doc_id, text, len(list_filter(regexp_extract_all(lower(text), '{RUN}'), lambda x: x = 'with')) AS n FROM documents)
SELECT doc_id, {_twice(_twice(_twice('text', 'WITH', 'BESIDE'), 'With', 'Beside'), '(?i:with)', 'beside')} AS text, CASE WHEN n > 0 THEN 'with: ' || n ELSE '' END AS edits FROM d""")
def rewritten(read):
    text, edits = R.rewrite(F.col("text"), [("with", "with", "beside")], R.WORD_EDGES)
    return read("documents").select("doc_id", text.alias("text"), F.array_join(edits, ",").alias("edits"))


@query("agg10_edit_histogram", f"""WITH r AS (SELECT regexp_extract_all(lower(text), '{RUN}') AS w FROM documents) SELECT label, count(*) AS items FROM (SELECT unnest([CASE WHEN list_contains(w, 'with') THEN 'with' END, CASE WHEN list_contains(w, 'that') THEN 'that' END]) AS label FROM r) WHERE label IS NOT NULL GROUP BY label""")
def edit_histogram(read):
    _, edits = R.rewrite(F.col("text"), [("with", "with", "beside"), ("that", "that", "which")], R.WORD_EDGES)
    per = read("documents").select(F.explode(edits).alias("e"))
    return per.groupBy(F.split("e", ":")[0].alias("label")).agg(F.count(F.lit(1)).alias("items"))


#: Texts of which some differ from others in white space or Unicode form only, and some in case.
VARIED = "SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN '  ' || replace(text, ' ', chr(160) || ' ') WHEN 1 THEN replace(text, 'é', 'e' || chr(769)) WHEN 2 THEN translate(text, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ') ELSE text END AS text FROM documents"
VARIED_GROUPS = f"v AS ({VARIED}), " + GROUPS.replace("FROM documents", "FROM v")


@query("agg5_duplicate_groups", f"WITH {VARIED_GROUPS} SELECT g AS group_id, doc_id, count(*) OVER (PARTITION BY g) AS size FROM h WHERE g IS NOT NULL QUALIFY count(*) OVER (PARTITION BY g) > 1")
def duplicate_groups(read):
    k, t = F.col("doc_id") % 4, F.col("text")
    spaced = F.concat(F.lit("  "), F.replace(t, F.lit(" "), F.lit("\u00a0 ")))
    varied = F.when(k == 0, spaced).when(k == 1, F.replace(t, F.lit("\u00e9"), F.lit("e\u0301"))).when(k == 2, F.translate(t, ascii_lowercase, ascii_uppercase)).otherwise(t)
    return V.duplicate_groups(read("documents").select("doc_id", varied.alias("text")), "doc_id", "text")


@query("agg6_invariance", f"""WITH {GROUPS}, x AS (SELECT g, {RENDERED} AS r FROM h), s AS (SELECT g FROM h GROUP BY g HAVING count(*) > 1)
SELECT g AS group_id, count(r) AS present, count(DISTINCT r) AS renderings, count(DISTINCT r) = 1 AS invariant FROM x JOIN s USING (g) GROUP BY g HAVING count(r) > 1""")
def invariance(read):
    rendered = F.when(F.col("doc_id") % 7 == 0, F.reverse("text")).when(F.col("doc_id") % 5 != 0, F.col("text"))
    return V.invariance(_groups(read), read("documents").select("doc_id", rendered.alias("rendered")), "doc_id", "rendered")


@query("con9_group_choice", f"""WITH {GROUPS}, s AS (SELECT g, min(doc_id) AS a FROM h WHERE g IS NOT NULL GROUP BY g HAVING count(*) > 1)
SELECT g AS group_id, CASE WHEN a % 3 = 0 THEN 'not_an_option' WHEN a % 3 = 1 THEN 'ok' ELSE 'no_choice' END AS status FROM s""")
def group_choice(read):
    groups = _groups(read)
    low = groups.groupBy("group_id").agg(F.min("doc_id").alias("a"))
    made = low.filter("a % 3 <> 2").select("group_id", F.when(F.col("a") % 3 == 0, -1).otherwise(F.col("a")).alias("choice"))
    options = groups.select("group_id", F.col("doc_id").alias("choice"), F.lit(True).alias("known"))
    status = F.when(F.col("choice").isNull(), "no_choice").when(F.col("known").isNull(), "not_an_option").otherwise("ok")
    return low.join(made, "group_id", "left").join(options, ["group_id", "choice"], "left").select("group_id", status.alias("status"))


LEMMAS = rf"(SELECT doc_id, unnest(regexp_extract_all(lower(text), '{LEMMA}')) AS lemma FROM documents)"


@query("agg7_glossary", f"""WITH p AS (SELECT lemma AS term, doc_id, count(*) AS n FROM {LEMMAS} GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY term ORDER BY doc_id) AS k FROM p)
SELECT term, sum(n)::BIGINT AS uses, count(*) AS refs, string_agg(doc_id::VARCHAR, ', ' ORDER BY doc_id) FILTER (k <= 12) || CASE WHEN count(*) > 12 THEN ', ...' ELSE '' END AS first_refs FROM r GROUP BY term""")
def glossary(read):
    return M.glossary(_lemmas(read).withColumnRenamed("lemma", "term"), "term", "doc_id")


@query("agg9_lemma_document_frequency", f"SELECT lemma, count(DISTINCT doc_id) AS df FROM {LEMMAS} GROUP BY lemma")
def lemma_df(read):
    return _distinct_lemmas(read).groupBy("lemma").agg(F.count("doc_id").alias("df"))  # doc_id is unique


@query("res10_concordance", f"""WITH w AS (SELECT DISTINCT doc_id, lemma FROM {LEMMAS}), d AS (SELECT lemma, count(*) AS df FROM w GROUP BY lemma HAVING count(*) BETWEEN 2 AND 29),
r AS (SELECT lemma, doc_id, df, row_number() OVER (PARTITION BY lemma ORDER BY doc_id) AS k FROM w JOIN d USING (lemma)) SELECT lemma, df, string_agg(doc_id::VARCHAR, ',' ORDER BY doc_id) AS first_refs FROM r WHERE k <= 3 GROUP BY lemma, df""")
def concordance(read):
    w = written(_distinct_lemmas(read), "lemmas")  # texts are cut into words once
    df = w.groupBy("lemma").agg(F.count(F.lit(1)).alias("df")).filter("df between 2 and 29")  # cut before the join: frequent words never meet
    few = w.join(df, "lemma").groupBy("lemma", "df").agg(F.sort_array(F.collect_list("doc_id")).alias("refs"))
    return few.select("lemma", "df", F.array_join(F.slice("refs", 1, 3).cast("array<string>"), ",").alias("first_refs"))


@query("res10_unit_concordance", f"""WITH w AS (SELECT DISTINCT doc_id, doc_id // 8 AS unit, length(text) AS len, lemma FROM (SELECT doc_id, text, unnest(regexp_extract_all(lower(text), '{LEMMA}')) AS lemma FROM documents)), d AS (SELECT lemma, count(*) AS df FROM w GROUP BY lemma HAVING count(*) < 30),
k AS (SELECT w.*, df FROM w JOIN d USING (lemma)), u AS (SELECT DISTINCT unit, lemma, df FROM k), o AS (SELECT u.unit, u.lemma, k.doc_id, row_number() OVER (PARTITION BY u.unit, u.lemma ORDER BY k.doc_id) AS n, row_number() OVER (PARTITION BY u.unit, u.lemma ORDER BY k.len, k.doc_id) AS s FROM u JOIN k ON u.lemma = k.lemma AND u.unit <> k.unit)
SELECT unit, lemma, df, coalesce(string_agg(doc_id::VARCHAR, ',' ORDER BY doc_id) FILTER (n <= 3), '') AS first_refs, min(doc_id) FILTER (s = 1) AS exemplar FROM u LEFT JOIN o USING (unit, lemma) GROUP BY unit, lemma, df""")
def unit_concordance(read):
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(LEMMA), F.lit(0)))
    w = read("documents").select("doc_id", F.floor(F.col("doc_id") / 8).alias("unit"), F.length("text").alias("len"), F.explode(words).alias("lemma"))
    found = M.concordance(w, "lemma", "unit", "doc_id", "len")
    return found.select("unit", "lemma", "df", F.array_join(F.col("outside").cast("array<string>"), ",").alias("first_refs"), "exemplar")


@query("gat15_word_sequence", f"SELECT doc_id, regexp_extract_all(lower(text), '{LEMMA}') = regexp_extract_all(lower(CASE WHEN doc_id % 4 = 0 THEN text || ' more' ELSE '  ' || text || '!' END), '{LEMMA}') AS equal FROM documents")
def word_sequence(read):
    words = lambda c: F.regexp_extract_all(F.lower(c), F.lit(LEMMA), F.lit(0))
    other = F.when(F.col("doc_id") % 4 == 0, F.concat("text", F.lit(" more"))).otherwise(F.concat(F.lit("  "), "text", F.lit("!")))
    return read("documents").select("doc_id", (words(F.col("text")) == words(other)).alias("equal"))


@query("res3_accept_gated_overlay", "SELECT doc_id, CASE WHEN doc_id % 3 = 0 AND doc_id % 2 = 0 THEN 'revised: ' || text ELSE text END AS final_text, CASE WHEN doc_id % 3 = 0 AND doc_id % 2 = 0 AND text IS NOT NULL THEN 'revision' ELSE 'base' END AS layer FROM documents")
def accept_gated(read):
    d = read("documents").select("doc_id", "text")
    revised = d.filter("doc_id % 3 = 0").select("doc_id", F.concat(F.lit("revised: "), "text").alias("revision"))
    verdicts = d.select("doc_id", (F.col("doc_id") % 2 == 0).alias("accept"))
    return V.accept_gated(d, revised, verdicts, "doc_id").select("doc_id", "final_text", "layer")


@query("con2_grounded_findings", r"""WITH f AS (SELECT doc_id, toxic, quality, text, CASE WHEN doc_id % 5 = 0 THEN 'zzzz' ELSE translate(substr(text, 1, 20), 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ') END AS quote, CASE WHEN doc_id % 3 = 0 THEN 'pass' ELSE 'revise' END AS verdict FROM labels JOIN documents USING (doc_id)),
n AS (SELECT *, toxic = 1 OR quality = 0 AS has, trim(regexp_replace(lower(text), '\s+', ' ', 'g')) AS t, trim(regexp_replace(lower(quote), '\s+', ' ', 'g')) AS q FROM f)
SELECT doc_id, problem FROM (SELECT doc_id, unnest([CASE WHEN has AND NOT (length(trim(quote)) > 0 AND contains(t, q)) THEN 'ungrounded' END, CASE WHEN has = (verdict = 'pass') THEN 'verdict_mismatch' END, CASE WHEN toxic = 1 AND verdict <> 'revise' THEN 'severe_without_revise' END]) AS problem FROM n) WHERE problem IS NOT NULL""")
def grounded_findings(read):
    d = read("labels").join(read("documents").select("doc_id", "text"), "doc_id")
    d = d.withColumn("quote", F.when(F.col("doc_id") % 5 == 0, "zzzz").otherwise(F.translate(F.substring("text", 1, 20), ascii_lowercase, ascii_uppercase)))
    d = d.withColumn("verdict", F.when(F.col("doc_id") % 3 == 0, "pass").otherwise("revise"))
    has = (F.col("toxic") == 1) | (F.col("quality") == 0)
    checks = [
        ("ungrounded", ~has | C.grounded(F.col("text"), F.col("quote"))),
        ("verdict_mismatch", has != (F.col("verdict") == "pass")),
        ("severe_without_revise", (F.col("toxic") != 1) | (F.col("verdict") == "revise")),
    ]
    return C.failures(d, ["doc_id"], checks)
