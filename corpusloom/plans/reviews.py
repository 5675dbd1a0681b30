"""Queries on import decisions, whole contracts, scorecards, reuse, media and observation rules, and file sources."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from corpusloom.functions.storage import fresh_path
from corpusloom.operators import contracts as C
from corpusloom.operators import gates as G
from corpusloom.operators import matching as M
from corpusloom.operators import resolve as V
from corpusloom.operators import review as W
from corpusloom.operators import rules as R
from corpusloom.plans.base import ITEMS, ORACLES, QUERIES, items, query
from corpusloom.plans.gates import GROUPS
from corpusloom.plans.languages import RUN, _twice
from corpusloom.sources import files

DIGEST = "sha256(coalesce(length(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce('=' || {0}, '~'))"
PRINT = "count(*) || ':' || " + " || ':' || ".join(f"sum(('0x' || substr({DIGEST}, {15 * i + 1}, 15))::BIGINT::HUGEINT)" for i in range(4))
FINDINGS = "f AS (SELECT labels.doc_id, toxic, quality, text, source FROM labels JOIN documents USING (doc_id) WHERE toxic = 1 OR quality = 0)"
BAD = "(idiot|moron|scum|trash)"


def unnested(key: str, checks: list[tuple[str, str]], source: str) -> str:
    """SQL of one row per check (name, condition that must hold) that is false or null."""
    cases = ", ".join(f"CASE WHEN NOT coalesce({ok}, false) THEN '{name}' END" for name, ok in checks)
    return f"SELECT {key}, problem FROM (SELECT {key}, unnest([{cases}]) AS problem FROM {source}) WHERE problem IS NOT NULL"


def first_failing(checks: list[tuple[str, str]], passed: str) -> str:
    return "CASE " + " ".join(f"WHEN NOT coalesce({ok}, false) THEN '{name}'" for name, ok in checks) + f" ELSE '{passed}' END"


# --- sources, written from a table and read back


def source_query(name: str, oracle: str):
    """Register f(spark, read, path): it writes files under path and reads them back."""

    def register(f):
        def run(spark, sf_dir):
            return f(spark, lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet"), fresh_path(spark, name))

        QUERIES[name], ORACLES[name] = run, oracle
        return f

    return register


@source_query("src1_items_xml", f"WITH {ITEMS} SELECT row_number() OVER (ORDER BY coll, seq) AS global_no, coll, 'c' || coll AS coll_name, seq, ref, text, CASE WHEN seq = 1 THEN 'first' END AS marker FROM items")
def items_xml(spark, read, path):
    text = F.col("text")
    for plain, safe in (("&", "&amp;"), ("<", "&lt;"), ('"', "&quot;"), ("\n", "&#10;"), ("\r", "&#13;"), ("\t", "&#9;")):
        text = F.replace(text, F.lit(plain), F.lit(safe))
    marker = F.when(F.col("seq") == 1, ' marker="first"').otherwise("")
    line = F.concat(F.lit('<item index="'), F.col("seq").cast("string"), F.lit('" text="'), text, F.lit('"'), marker, F.lit("/>"))
    per = items(read).groupBy("coll").agg(F.array_join(F.collect_list(line), "").alias("b"))  # the items of one collection
    per.select(F.concat(F.lit('<collection index="'), "coll", F.lit('" name="c'), "coll", F.lit('">'), "b", F.lit("</collection>")).alias("value")).write.option("maxRecordsPerFile", 1).text(path)  # a file has one root
    return files.read_items_xml(spark, path)


@source_query("src3_token_lines", f"""WITH {ITEMS}, w AS (SELECT coll, seq, string_split(text, ' ') AS l FROM items), e AS (SELECT coll, seq, unnest(range(1, len(l) + 1)) AS word, regexp_replace(unnest(l), '[\\t\\r\\n]', '_', 'g') AS form FROM w)
SELECT coll, seq, word, 1::BIGINT AS segment, form, 'N' AS pos, md5(lower(form)) AS lemma FROM e""")
def token_lines(spark, read, path):
    form = F.regexp_replace("form", r"[\t\r\n]", "_")
    each = items(read).select("coll", "seq", F.posexplode(F.split("text", " ")).alias("i", "form")).withColumn("form", form)
    where = F.concat_ws(":", "coll", "seq", F.col("i") + 1, F.lit(1))
    each.select(F.concat_ws("\t", where, "form", F.lit("N"), F.concat(F.lit("LEM:"), F.md5(F.lower("form")), F.lit("|ROOT:x"))).alias("value")).write.text(path)
    return files.read_tokens_tsv(spark, path).select("coll", "seq", "word", "segment", "form", "pos", F.col("features")["LEM"].alias("lemma"))


@source_query("src4_artifacts", f"WITH {ITEMS} SELECT coll AS unit, count(*) AS n, max(text) AS longest FROM items WHERE coll % 13 <> 0 GROUP BY coll")
def artifacts(spark, read, path):
    per = items(read).groupBy("coll").agg(F.count(F.lit(1)).alias("n"), F.max("text").alias("longest"))
    body = F.when(F.col("coll") % 13 == 0, "{broken").otherwise(F.to_json(F.struct(F.col("coll").alias("unit"), "n", "longest")))
    per.select(body.alias("value")).write.option("maxRecordsPerFile", 1).text(path)  # one document per file
    return files.read_artifacts(spark, path, "unit long, n long, longest string").select("unit", "n", "longest")


@query("src2_reimport_decision", f"""WITH a AS (SELECT source, {PRINT.format('text')} AS p FROM documents GROUP BY source), b AS (SELECT source, {PRINT.format("CASE WHEN doc_id % 90 = 0 THEN text || '.' ELSE text END")} AS p FROM documents GROUP BY source), d AS (SELECT DISTINCT source FROM labels JOIN documents USING (doc_id) WHERE toxic = 1 AND doc_id % 4 = 0)
SELECT source, CASE WHEN a.p = b.p THEN 'noop' WHEN d.source IS NOT NULL THEN 'reject' ELSE 'replace' END AS action, CASE WHEN d.source IS NULL THEN b.p ELSE a.p END AS receipt FROM a JOIN b USING (source) LEFT JOIN d USING (source)""")
def reimport_decision(read):
    d = read("documents").select("source", "doc_id", "text")
    new = d.withColumn("text", F.when(F.col("doc_id") % 90 == 0, F.concat("text", F.lit("."))).otherwise(F.col("text")))
    dependents = read("labels").filter("toxic = 1 and doc_id % 4 = 0").join(d.select("doc_id", "source"), "doc_id")
    return W.reimport_decision(d, new, dependents, "source", "doc_id", "text")


# --- rewriting and passages


@query("prj10_publication_rewrite", f"""WITH d AS (SELECT doc_id, text, (length(text) - length(replace(text, 'of the', ''))) // 6 AS p, replace(text, 'of the', 'OF THIS') AS t FROM documents),
w AS (SELECT doc_id, p, len(list_filter(regexp_extract_all(lower(t), '{RUN}'), lambda x: x = 'with')) AS n, {_twice(_twice(_twice('t', 'WITH', 'BESIDE'), 'With', 'Beside'), '(?i:with)', 'beside')} AS t FROM d)
SELECT doc_id, regexp_replace(t, '[0-9]{{4,}}', '0000', 'g') AS text, concat_ws(',', CASE WHEN p > 0 THEN 'of the: ' || p END, CASE WHEN n > 0 THEN 'with: ' || n END, CASE WHEN regexp_matches(t, '[0-9]{{4,}}') THEN 'digits: ' || len(regexp_extract_all(t, '[0-9]{{4,}}')) END) AS edits FROM w""")
def publication_rewrite(read):
    text, edits = W.publish(F.col("text"), [("of the", "OF THIS")], [("with", "with", "beside")], ("digits", "[0-9]{4,}", "0000"))
    return read("documents").select("doc_id", text.alias("text"), F.array_join(edits, ",").alias("edits"))


@query("jon10_release_passages", f"""WITH {ITEMS}, r AS (SELECT coll, seq, text FROM items WHERE (coll + seq) % 7 <> 0 UNION ALL SELECT coll, seq, text FROM items WHERE (coll + seq) % 11 = 0 AND (coll + seq) % 7 <> 0), c AS (SELECT DISTINCT coll, unnest(range(1, 4)) AS seq FROM items),
n AS (SELECT c.coll, c.seq, count(r.coll) AS n, min(text) AS t FROM c LEFT JOIN r ON r.coll = c.coll AND r.seq = c.seq GROUP BY ALL)
SELECT coll, CASE WHEN count(*) FILTER (n <> 1) = 0 THEN string_agg(t, ' ' ORDER BY seq) END AS passage, count(*) FILTER (n = 0) AS missing, count(*) FILTER (n > 1) AS repeated FROM n GROUP BY coll""")
def release_passages(read):
    it, at = items(read), (F.col("coll") + F.col("seq"))
    kept = it.filter(at % 7 != 0)
    candidates = it.select("coll").distinct().withColumns({"first": F.lit(1).cast("long"), "last": F.lit(3).cast("long")})
    return W.passage_text(candidates.withColumn("id", F.col("coll")), kept.union(kept.filter(at % 11 == 0)), "id").withColumnRenamed("id", "coll")


# --- contracts


@query("con1_response_forms", f"""WITH {ITEMS}, x AS (SELECT coll, ref, CASE WHEN coll % 17 = 0 OR (coll + seq) % 7 = 0 THEN 'missing' WHEN (coll + seq) % 11 = 0 THEN 'duplicate' WHEN (coll + seq) % 13 = 0 OR trim(coalesce(text, '')) = '' THEN 'empty' WHEN (coll + seq) % 5 = 0 THEN 'incomplete_term' END AS problem FROM items)
SELECT * FROM x WHERE problem IS NOT NULL UNION ALL SELECT DISTINCT coll, 'x:' || coll, 'unknown' FROM items WHERE coll % 9 = 0 AND coll % 17 <> 0 UNION ALL SELECT DISTINCT coll, NULL, 'unreadable' FROM items WHERE coll % 17 = 0""")
def response_forms(read):
    it, at, coll = items(read), F.col("coll") + F.col("seq"), F.col("coll")
    text = F.when((at % 13 == 0) & (at % 11 != 0), F.lit(" ")).otherwise(F.col("text"))
    terms = F.array(F.struct(F.lit("t").alias("term"), F.when(at % 5 != 0, "r").otherwise(" ").alias("root")))
    entry = F.array_repeat(F.struct("ref", text.alias("text"), terms.alias("terms")), F.when(at % 7 == 0, 0).when(at % 11 == 0, 2).otherwise(1))
    none = F.array().cast(W.TERMS)
    stray = F.array_repeat(F.struct(F.concat(F.lit("x:"), coll).alias("ref"), F.lit("u").alias("text"), none.alias("terms")), F.when(coll % 9 == 0, 1).otherwise(0))
    made = it.groupBy("coll").agg(F.flatten(F.collect_list(entry)).alias("rows")).select("coll", F.to_json(F.concat("rows", stray)).alias("j"))
    held = F.concat(F.lit('{"translations": '), "j", F.lit("}"))
    body = F.when(coll % 17 == 0, "no answer").when(coll % 4 == 0, F.concat(F.lit("```json\n"), "j", F.lit("\n```"))).when(coll % 4 == 1, F.concat(F.lit("Here it is: "), held, F.lit(" Done."))).when(coll % 4 == 2, held).otherwise(F.col("j"))
    return W.entry_issues(W.response_entries(made.select("coll", body.alias("body")), "coll"), it.select("coll", "ref"), "coll")


@query("con2_ordered_findings", r"""WITH e AS (SELECT doc_id // 16 AS unit, doc_id AS seq, text, source, toxic = 1 OR quality = 0 AS has, CASE WHEN doc_id // 16 % 5 = 0 THEN -doc_id ELSE doc_id END AS place, CASE doc_id % 7 WHEN 0 THEN 'odd' WHEN 1 THEN 'omission' ELSE 'meaning' END AS type, CASE WHEN doc_id % 6 = 0 THEN 'huge' WHEN toxic = 1 THEN 'major' ELSE 'minor' END AS severity,
 CASE WHEN doc_id % 4 = 1 THEN '<missing>' WHEN doc_id % 9 = 0 THEN '####' ELSE substr(text, 1, 12) END AS quote, CASE WHEN doc_id % 8 = 0 THEN 'nowhere' ELSE source END AS ground, CASE WHEN doc_id % 3 = 0 THEN 'pass' ELSE 'revise' END AS verdict FROM labels JOIN documents USING (doc_id)),
k AS (SELECT *, row_number() OVER (PARTITION BY unit ORDER BY place) AS p, row_number() OVER (PARTITION BY unit ORDER BY seq) AS s, trim(regexp_replace(lower(text), '\s+', ' ', 'g')) AS t, trim(regexp_replace(lower(quote), '\s+', ' ', 'g')) AS q FROM e) """
 + unnested("unit, seq", [("order", "p = s"), ("type", "NOT has OR type IN ('meaning', 'omission')"), ("severity", "NOT has OR severity IN ('major', 'minor')"), ("quote", "NOT has OR quote = '<missing>' OR (length(trim(quote)) > 0 AND contains(t, q))"), ("missing_mark", "NOT has OR quote <> '<missing>' OR type = 'omission'"),
 ("ground", "NOT has OR (length(trim(ground)) > 0 AND contains(lower(source), lower(ground)))"), ("verdict", "has <> (verdict = 'pass')"), ("severe_without_revise", "NOT (has AND severity = 'major') OR verdict = 'revise'")], "k"))
def ordered_findings(read):
    k = F.col("doc_id")
    d = read("labels").join(read("documents").select("doc_id", "text", "source"), "doc_id").withColumn("unit", F.floor(k / 16)).withColumn("seq", k)
    has = (F.col("toxic") == 1) | (F.col("quality") == 0)
    made = d.select(
        "unit", "seq", F.when(F.col("unit") % 5 == 0, -k).otherwise(k).alias("place"),
        F.when(has, F.when(k % 7 == 0, "odd").when(k % 7 == 1, "omission").otherwise("meaning")).alias("type"),
        F.when(k % 6 == 0, "huge").when(F.col("toxic") == 1, "major").otherwise("minor").alias("severity"),
        F.when(k % 4 == 1, "<missing>").when(k % 9 == 0, "####").otherwise(F.substring("text", 1, 12)).alias("quote"),
        F.when(k % 8 == 0, "nowhere").otherwise(F.col("source")).alias("ground"), F.when(k % 3 == 0, "pass").otherwise("revise").alias("verdict"),
    )
    return W.ordered_findings(made, d.select("unit", "seq", "text", "source"), "unit", "seq", ["meaning", "omission"], ["major", "minor"], ["major"])


@query("con4_blind_audit_scores", unnested("doc_id", [("candidate_order", "doc_id % 4 <> 3"), ("missing_score", "doc_id % 7 <> 0"), ("unknown_score", "doc_id % 11 <> 0"), ("score_range", "doc_id % 6 BETWEEN 1 AND 5 AND doc_id % 5 + 1 BETWEEN 1 AND 5")], "labels"))
def blind_audit_scores(read):
    k = F.col("doc_id")
    scores = F.create_map(F.lit("accuracy"), k % 6, F.lit("clarity"), k % 5 + 1)
    scores = F.when(k % 7 == 0, scores).otherwise(F.map_concat(scores, F.create_map(F.lit("style"), F.lit(3).cast("long"))))
    scores = F.when(k % 11 == 0, F.map_concat(scores, F.create_map(F.lit("tone"), F.lit(2).cast("long")))).otherwise(scores)
    order = F.when(k % 4 == 3, F.array(F.lit("c1"), F.lit("c0"), F.lit("c2"))).otherwise(F.array(F.lit("c0"), F.lit("c1"), F.lit("c2")))
    return W.audit_issues(read("labels").select("doc_id", order.alias("order"), scores.alias("scores")), "doc_id", ["accuracy", "clarity", "style"], ["c0", "c1", "c2"])


@query("con6_decision_fields", f"""WITH {FINDINGS}, d AS (SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN 'maybe' ELSE 'applied' END AS v, CASE WHEN doc_id % 8 = 1 THEN ' ' ELSE 'so' END AS r FROM f WHERE doc_id % 3 <> 0 UNION ALL SELECT doc_id, 'rejected', 'so' FROM f WHERE doc_id % 5 = 0 UNION ALL SELECT doc_id + 1000000, 'rejected', NULL FROM f WHERE doc_id % 17 = 0),
g AS (SELECT doc_id, count(*) AS n, bool_and(v IN ('applied', 'rejected', 'escalated')) AS ok, bool_and(trim(coalesce(r, '')) <> '') AS why FROM d GROUP BY doc_id), b AS (SELECT coalesce(f.doc_id, g.doc_id) AS doc_id, f.doc_id IS NOT NULL AS known, n, ok, why FROM f FULL JOIN g ON f.doc_id = g.doc_id) """
 + unnested("doc_id", [("unknown_finding", "known"), ("undecided", "n IS NOT NULL"), ("decided_twice", "n IS NULL OR n = 1"), ("decision", "n IS NULL OR ok"), ("reason", "n IS NULL OR why")], "b"))
def decision_fields(read):
    k = F.col("doc_id")
    f = read("labels").filter("toxic = 1 or quality = 0").join(read("documents").select("doc_id"), "doc_id").select("doc_id")
    given = lambda rows, value, reason: rows.select("doc_id", F.lit(value).alias("decision") if isinstance(value, str) else value.alias("decision"), reason.alias("reason"))
    d = given(f.filter("doc_id % 3 <> 0"), F.when(k % 7 == 0, "maybe").otherwise("applied"), F.when(k % 8 == 1, " ").otherwise("so"))
    d = d.union(given(f.filter("doc_id % 5 = 0"), "rejected", F.lit("so"))).union(given(f.filter("doc_id % 17 = 0").select((k + 1000000).alias("doc_id")), "rejected", F.lit(None).cast("string")))
    return W.decision_fields(f, d, "doc_id", ["applied", "rejected", "escalated"])


@query("con11_batch_costs", """WITH u AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 9 = 0 THEN 'missing' WHEN o_orderstatus = 'P' THEN 'error' END AS reason, coalesce(CASE WHEN o_orderkey % 4 <> 0 THEN o_orderkey % 1000 END, ceil(o_totalprice / 1000 * 25)::BIGINT) AS tokens FROM orders)
SELECT o_custkey, CASE WHEN count(reason) > 0 THEN 'collected_with_failures' ELSE 'collected' END AS state, coalesce(string_agg(DISTINCT reason, ',' ORDER BY reason), '') AS reasons, coalesce(sum(tokens) FILTER (reason IS NULL), 0)::BIGINT AS tokens, coalesce(sum(tokens * 3) FILTER (reason IS NULL), 0)::BIGINT AS micro_cost FROM u GROUP BY o_custkey""")
def batch_costs(read):
    o, k = read("orders"), F.col("o_orderkey")
    results = o.filter("o_orderkey % 9 <> 0").select("o_orderkey", F.when(F.col("o_orderstatus") == "P", "error").otherwise("ok").alias("r"), F.coalesce(F.when(k % 4 != 0, k % 1000), F.ceil(F.col("o_totalprice") / 1000 * 25)).alias("tokens"))
    both = o.select("o_orderkey", "o_custkey").join(results, "o_orderkey", "left").withColumn("reason", F.when(F.col("r").isNull(), "missing").when(F.col("r") == "error", "error"))
    used = F.when(F.col("reason").isNull(), F.col("tokens"))
    state = F.when(F.count("reason") > 0, "collected_with_failures").otherwise("collected")
    zero = F.lit(0).cast("long")
    return both.groupBy("o_custkey").agg(state.alias("state"), F.array_join(F.array_sort(F.collect_set("reason")), ",").alias("reasons"), F.coalesce(F.sum(used), zero).alias("tokens"), F.coalesce(F.sum(used * 3), zero).alias("micro_cost"))


# --- scorecards and cohorts


CASES = rf"""c AS (SELECT doc_id, toxic = 1 AS defect, doc_id % 10 = 0 AS required, text FROM labels JOIN documents USING (doc_id)), h AS (SELECT *, len(list_distinct(list_filter(regexp_extract_all(lower(text), '{RUN}'), lambda x: x IN ('idiot', 'moron', 'scum', 'trash')))) AS n, contains(text, ' | ') AS pipe FROM c),
p AS (SELECT doc_id, defect, required, CASE WHEN defect THEN n >= 1 ELSE NOT (n >= 1 OR pipe) END AS passed FROM h)"""


def _case_results(read):
    d = read("labels").join(read("documents").select("doc_id", "text"), "doc_id")
    defect = F.col("toxic") == 1
    cases = d.select("doc_id", defect.alias("defect"), F.array(F.lit("slur")).alias("types"), F.lit(1).alias("least"), (F.col("doc_id") % 10 == 0).alias("required"))
    found = F.split(R.banned_terms(F.col("text"), ["idiot", "moron", "scum", "trash"], R.WORD_EDGES), ",")
    slurs = d.select("doc_id", F.explode(found).alias("t")).filter("t <> ''").groupBy("doc_id").agg(F.count(F.lit(1)).cast("int").alias("severity")).select("doc_id", F.lit("slur").alias("type"), "severity")
    pipes = d.filter(F.contains("text", F.lit(" | "))).select("doc_id", F.lit("layout").alias("type"), F.lit(1).alias("severity"))
    return W.case_results(cases, slurs.unionByName(pipes), "doc_id")


@query("agg14_case_results", f"WITH {CASES} SELECT doc_id, defect, required, passed FROM p")
def case_results(read):
    return _case_results(read).select("doc_id", "defect", "required", "passed")


@query("agg14_required_scorecard", f"""WITH {CASES}, s AS (SELECT count(*) AS cases, round(count(*) FILTER (defect AND passed) / count(*) FILTER (defect), 6) AS recall, round(count(*) FILTER (NOT defect AND NOT passed) / count(*) FILTER (NOT defect), 6) AS false_positive_rate, count(*) FILTER (required AND NOT passed) AS required_failed FROM p)
SELECT *, recall >= 0.8 AND false_positive_rate <= 0.2 AND required_failed = 0 AS accepted FROM s""")
def required_scorecard(read):
    return W.scorecard(_case_results(read), 0.8, 0.2)


@query("agg15_cohort_metrics", """WITH e AS (SELECT event_type, user_id % 3 AS platform, dayofweek(ts) + 1 AS weekday, hour(ts) // 12 AS half, event_id % 2 AS variant, value >= 50 AS long_form, 'day' AS basis, CASE WHEN event_id % 6 <> 0 THEN round(value * 100)::BIGINT END AS v, CASE WHEN event_id % 5 <> 0 THEN user_id % 7 + 1 END AS w FROM events),
r AS (SELECT *, row_number() OVER (PARTITION BY event_type, platform, weekday, half, variant, long_form, basis ORDER BY v NULLS LAST) AS k, count(v) OVER (PARTITION BY event_type, platform, weekday, half, variant, long_form, basis) AS n FROM e)
SELECT event_type, platform, weekday, half, variant, long_form, basis, count(v) AS known, count(*) - count(v) AS unknown, max(v) FILTER (n > 0 AND k = (n + 1) // 2) AS lower, max(v) FILTER (n > 0 AND k = n // 2 + 1) AS upper, round((max(v) FILTER (n > 0 AND k = (n + 1) // 2) + max(v) FILTER (n > 0 AND k = n // 2 + 1)) / 2, 6) AS median,
 round(sum(v) FILTER (w IS NOT NULL) / sum(w) FILTER (v IS NOT NULL), 6) AS paired_rate, count(v) >= 5 AS enough FROM r GROUP BY ALL""")
def cohort_metrics(read):
    k = F.col("event_id")
    ev = read("events").select("event_type", (F.col("user_id") % 3).alias("platform"), F.dayofweek("ts").cast("long").alias("weekday"), F.floor(F.hour("ts") / 12).alias("half"), (k % 2).alias("variant"), (F.col("value") >= 50).alias("long_form"), F.lit("day").alias("basis"),
                              F.when(k % 6 != 0, F.round(F.col("value") * 100).cast("long")).alias("v"), F.when(k % 5 != 0, F.col("user_id") % 7 + 1).alias("w"))
    return W.cohort_metrics(ev, ["event_type", "platform", "weekday", "half", "variant", "long_form", "basis"], "v", "w", 5)


@query("agg20_held_spend", """WITH c AS (SELECT o_custkey, o_orderstatus AS s, round(o_totalprice * 100)::BIGINT AS c FROM orders) SELECT o_custkey, coalesce(sum(c) FILTER (s = 'F'), 0)::BIGINT AS spent, coalesce(sum(c) FILTER (s = 'O'), 0)::BIGINT AS held, (500000000 - coalesce(sum(c) FILTER (s IN ('F', 'O')), 0))::BIGINT AS remaining FROM c GROUP BY o_custkey""")
def held_spend(read):
    c = read("orders").select("o_custkey", F.col("o_orderstatus").alias("s"), F.round(F.col("o_totalprice") * 100).cast("long").alias("c"))
    total = lambda *states: F.coalesce(F.sum(F.when(F.col("s").isin(*states), F.col("c"))), F.lit(0).cast("long"))
    return c.groupBy("o_custkey").agg(total("F").alias("spent"), total("O").alias("held"), (F.lit(500000000) - total("F", "O")).alias("remaining"))


# --- resolution


@query("res2_gated_layers", f"""WITH {GROUPS}, o AS (SELECT g, min(doc_id) AS m FROM h GROUP BY g), x AS (SELECT h.doc_id, 'group ' || m AS t FROM h JOIN o USING (g) WHERE m % 2 = 0), l AS (SELECT d.*, x.t AS x, CASE WHEN x.t IS NOT NULL THEN 'group' WHEN d.doc_id % 4 = 0 AND d.doc_id % 11 <> 0 AND text IS NOT NULL THEN 'repair' WHEN d.doc_id % 3 = 0 AND d.doc_id % 7 <> 0 AND text IS NOT NULL THEN 'revision' ELSE 'draft' END AS layer FROM documents d LEFT JOIN x USING (doc_id))
SELECT doc_id, CASE layer WHEN 'group' THEN x WHEN 'repair' THEN '2:' || text WHEN 'revision' THEN '1:' || text ELSE text END AS final_text, layer FROM l""")
def gated_layers(read):
    d = read("documents").select("doc_id", "text")
    groups = V.duplicate_groups(d.filter("text is not null"), "doc_id", "text")
    chosen = groups.groupBy("group_id").agg(F.min("doc_id").alias("m")).filter("m % 2 = 0").select("group_id", F.concat(F.lit("group "), "m").alias("text"))
    over = groups.join(chosen, "group_id").select("doc_id", "text")
    layer = lambda rows, mark: rows.select("doc_id", F.concat(F.lit(mark), "text").alias("text"))
    return W.gated_layers(d, layer(d.filter("doc_id % 7 <> 0"), "1:"), layer(d.filter("doc_id % 11 <> 0"), "2:"), d.filter("doc_id % 3 = 0"), d.filter("doc_id % 4 = 0"), over, "doc_id")


@query("res5_group_work_items", f"""WITH {GROUPS}, p AS (SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN text || '?' ELSE text END AS t FROM documents), x AS (SELECT g, h.doc_id, md5(t) AS o FROM h JOIN p USING (doc_id)), w AS (SELECT g, min(doc_id) AS doc_id, string_agg(DISTINCT o, ',' ORDER BY o) AS options FROM x GROUP BY g HAVING count(DISTINCT o) > 1)
SELECT w.doc_id, options, left(b.text, 20) AS before, left(a.text, 20) AS after FROM w LEFT JOIN documents b ON b.doc_id = w.doc_id - 1 LEFT JOIN documents a ON a.doc_id = w.doc_id + 1 WHERE g NOT IN (SELECT g FROM h WHERE doc_id % 5 = 0)""")
def group_work_items(read):
    d = read("documents").select("doc_id", "text")
    groups = V.duplicate_groups(d.filter("text is not null"), "doc_id", "text")
    reading = d.select("doc_id", F.md5(F.when(F.col("doc_id") % 7 == 0, F.concat("text", F.lit("?"))).otherwise(F.col("text"))).alias("o"))
    readings = groups.join(reading, "doc_id").groupBy("group_id", "o").agg(F.min("doc_id").alias("m"))  # readings first, so copies are not collected
    open_ = readings.groupBy("group_id").agg(F.min("m").alias("doc_id"), F.array_join(F.array_sort(F.collect_list("o")), ",").alias("options"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    settled = groups.filter("doc_id % 5 = 0").select("group_id").distinct()
    one = F.lit(1).alias("s")
    items_ = open_.join(settled, "group_id", "left_anti").select("doc_id", "options", one)
    return W.neighbour_texts(items_, d.select("doc_id", "text", one), "s", "doc_id", "text", 20).select("doc_id", "options", "before", "after")


@query("res8_frozen_set_guard", f"""WITH now AS (SELECT source, {PRINT.format('text')} AS p FROM documents GROUP BY source), was AS (SELECT source, {PRINT.format("CASE WHEN doc_id % 150 = 1 THEN text || '+' ELSE text END")} AS p FROM documents GROUP BY source)
SELECT doc_id, {first_failing([("set_differs", "now.p = was.p"), ("text_differs", "doc_id % 5 <> 0 OR text IS NULL"), ("count_differs", "doc_id % 3 <> 0")], "applied")} AS status FROM documents JOIN now USING (source) JOIN was USING (source)""")
def frozen_set_guard(read):
    d, k = read("documents").select("doc_id", "source", "text"), F.col("doc_id")
    recorded = W.fingerprint(d.withColumn("text", F.when(k % 150 == 1, F.concat("text", F.lit("+"))).otherwise(F.col("text"))), "source", "doc_id", "text")
    edits = d.select("doc_id", F.when(k % 5 == 0, F.concat("text", F.lit("?"))).otherwise(F.col("text")).alias("before"), F.greatest(k % 3, F.lit(1)).alias("expected"), (k % 3).alias("unresolved"))
    return W.frozen_guard(edits, d, recorded, "source", "doc_id", "text")


@query("res9_remediation_packets", f"""WITH {GROUPS}, i AS (SELECT doc_id, 'paren' AS code FROM documents WHERE regexp_matches(text, '\\([^)]*\\)') UNION ALL SELECT doc_id, 'toxic' FROM labels WHERE toxic = 1), c AS (SELECT doc_id, string_agg(DISTINCT code, ',' ORDER BY code) AS codes FROM i GROUP BY doc_id),
t AS (SELECT doc_id, codes, false AS closure_only FROM c UNION ALL SELECT doc_id, '', true FROM h WHERE g IN (SELECT g FROM h JOIN c USING (doc_id)) AND doc_id NOT IN (SELECT doc_id FROM c)), z AS (SELECT g, count(*) AS n FROM h GROUP BY g)
SELECT t.doc_id, codes, closure_only, left(b.text, 16) AS before, left(a.text, 16) AS after, coalesce(z.n - 1, 0) AS parallels FROM t LEFT JOIN documents b ON b.doc_id = t.doc_id - 1 LEFT JOIN documents a ON a.doc_id = t.doc_id + 1 LEFT JOIN h ON h.doc_id = t.doc_id LEFT JOIN z USING (g)""")
def remediation_packets(read):
    d = read("documents").select("doc_id", "text")
    groups = V.duplicate_groups(d.filter("text is not null"), "doc_id", "text")
    toxic = read("labels").filter("toxic = 1").select("doc_id", F.lit("toxic").alias("code"), F.lit("error").alias("severity"))
    targets = G.remediation_targets(R.rule_issues(d, "doc_id", "text", {"paren": (r"\([^)]*\)", "error")}).unionByName(toxic), groups, "doc_id")
    sized = targets.join(groups.select("doc_id", (F.col("size") - 1).alias("p")), "doc_id", "left").withColumn("s", F.lit(1))
    packets = W.neighbour_texts(sized, d.withColumn("s", F.lit(1)), "s", "doc_id", "text", 16)
    return packets.select("doc_id", "codes", "closure_only", "before", "after", F.coalesce("p", F.lit(0).cast("long")).alias("parallels"))


@query("res11_rejudged_attempts", "SELECT user_id, min(event_id) FILTER ((props->>'k')::BIGINT > 60) AS before, min(event_id) FILTER ((props->>'k')::BIGINT > 30 AND value > 20) AS after FROM events GROUP BY user_id")
def rejudged_attempts(read):
    k = F.get_json_object("props", "$.k").cast("long")
    return W.rejudged(read("events"), ["user_id"], "event_id", k > 60, (k > 30) & (F.col("value") > 20))


SEED = [("new", "p.doc_id IS NOT NULL"), ("unit_hash", "p.u = n.u"), ("model", "p.m = n.m"), ("glossary", "p.a IS NOT DISTINCT FROM n.a"), ("notes", "p.b IS NOT DISTINCT FROM n.b"), ("invalid", "trim(p.r) <> ''")]


@query("res12_compatible_seed", f"""WITH n AS (SELECT doc_id, md5(text) AS u, 'm' || doc_id % 2 AS m, lang AS a, source AS b FROM documents),
p AS (SELECT doc_id, CASE WHEN doc_id % 6 = 0 THEN 'x' ELSE u END AS u, CASE WHEN doc_id % 5 = 0 THEN 'm9' ELSE m END AS m, CASE WHEN doc_id % 9 = 1 THEN NULL ELSE a END AS a, CASE WHEN doc_id % 13 = 1 THEN 'other' ELSE b END AS b, CASE WHEN doc_id % 10 = 3 THEN ' ' ELSE 'done' END AS r FROM n WHERE doc_id % 4 <> 0)
SELECT n.doc_id, {first_failing(SEED[:1] + [(k, "p.u IS NOT DISTINCT FROM n.u" if k == "unit_hash" else ok) for k, ok in SEED[1:]], "reused")} AS status FROM n LEFT JOIN p USING (doc_id)""".replace("USING (doc_id)", "ON p.doc_id = n.doc_id"))
def compatible_seed(read):
    k = F.col("doc_id")
    now = read("documents").select("doc_id", F.md5("text").alias("unit_hash"), F.concat(F.lit("m"), k % 2).alias("model"), F.col("lang").alias("glossary"), F.col("source").alias("notes"))
    prior = now.filter("doc_id % 4 <> 0").select("doc_id", F.when(k % 6 == 0, "x").otherwise(F.col("unit_hash")).alias("unit_hash"), F.when(k % 5 == 0, "m9").otherwise(F.col("model")).alias("model"),
                                                 F.when(k % 9 != 1, F.col("glossary")).alias("glossary"), F.when(k % 13 == 1, "other").otherwise(F.col("notes")).alias("notes"), F.when(k % 10 == 3, " ").otherwise("done").alias("result"))
    return W.seed_status(now, prior, "doc_id", ["glossary", "notes"])


# --- gates


SOURCES = """e AS (SELECT DISTINCT 'src' || (regexp_replace(source, '[^0-9]', '', 'g')::BIGINT + 1) AS source FROM documents WHERE source IS NOT NULL), a AS (SELECT source, count(*) AS n, bool_or(trim(coalesce(text, '')) = '') AS blank, arg_min(lang, doc_id) AS marker FROM documents GROUP BY source),
s AS (SELECT coalesce(e.source, a.source) AS source, e.source IS NOT NULL AS expected, a.source IS NOT NULL AS there, n, blank, marker FROM e FULL JOIN a ON a.source = e.source)"""
POLICY = [("unexpected_collection", "expected"), ("missing_collection", "there"), ("cardinality", "NOT there OR n = 50"), ("blank_text", "NOT there OR NOT blank"), ("marker", "NOT there OR marker = 'en'")]


def _source_issues(read):
    d = read("documents")
    expected = d.filter("source is not null").select(F.concat(F.lit("src"), F.regexp_replace("source", "[^0-9]", "").cast("long") + 1).alias("source")).distinct().withColumn("e", F.lit(True))
    actual = d.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.bool_or(F.trim(F.coalesce("text", F.lit(""))) == "").alias("blank"), F.min_by("lang", "doc_id").alias("marker"), F.lit(True).alias("a"))
    both, none = expected.join(actual, "source", "full"), F.col("a").isNull()
    return C.failures(both, ["source"], [("unexpected_collection", F.col("e")), ("missing_collection", ~none), ("cardinality", none | (F.col("n") == 50)), ("blank_text", none | ~F.col("blank")), ("marker", none | (F.col("marker") == "en"))])


@query("gat1_source_policy", f"WITH {SOURCES} {unnested('source', POLICY, 's')}")
def source_policy(read):
    return _source_issues(read)


RUN_ISSUES = f"""i AS (SELECT ref, 'missing_text' AS code, 'error' AS severity FROM items WHERE (coll * 7 + seq) % 13 = 0 UNION ALL SELECT 'unit ' || coll, 'failed_unit', 'error' FROM (SELECT DISTINCT coll FROM items) WHERE coll % 11 = 0
 UNION ALL SELECT ref, 'banned_term', 'error' FROM items WHERE len(list_filter(regexp_extract_all(lower(text), '{RUN}'), lambda x: x IN ('idiot', 'moron', 'scum', 'trash'))) > 0 AND (coll * 7 + seq) % 13 <> 0 UNION ALL SELECT ref, 'bracket', 'warning' FROM items WHERE contains(text, '[') AND (coll * 7 + seq) % 13 <> 0)"""


@query("gat2_run_gate_units", f"WITH {ITEMS}, {RUN_ISSUES} SELECT * FROM i UNION ALL SELECT '*', 'verdict', CASE WHEN count(*) FILTER (severity = 'error') = 0 THEN 'pass' ELSE 'fail' END FROM i")
def run_gate_units(read):
    it, error = items(read), F.lit("error").alias("severity")
    texts = it.filter((F.col("coll") * 7 + F.col("seq")) % 13 != 0)
    missing = it.join(texts.select("ref"), "ref", "left_anti").select("ref", F.lit("missing_text").alias("code"), error)
    failed = it.select("coll").distinct().filter("coll % 11 = 0").select(F.concat(F.lit("unit "), "coll").alias("ref"), F.lit("failed_unit").alias("code"), error)
    left, right = R.WORD_EDGES
    broken = R.rule_issues(texts, "ref", "text", {"banned_term": (f"(?i){left}{BAD}{right}", "error"), "bracket": (r"\[", "warning")})
    issues = missing.unionByName(failed).unionByName(broken)
    return issues.unionByName(V.verdict(issues).select(F.lit("*").alias("ref"), F.lit("verdict").alias("code"), F.when(F.col("passed"), "pass").otherwise("fail").alias("severity")))


NOTES = "SELECT 'unknown_source' FROM labels WHERE 'src' || doc_id % 30 NOT IN (SELECT source FROM documents WHERE source IS NOT NULL)"


@query("gat6_release_gate_whole", rf"""WITH {SOURCES}, {GROUPS}, o AS ({unnested('source', POLICY, 's')}), p AS (SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN text || '?' ELSE text END AS t FROM documents), i AS (SELECT problem AS code FROM o UNION ALL {NOTES} UNION ALL SELECT 'paren' FROM documents WHERE regexp_matches(text, '\([^)]*\)') UNION ALL SELECT 'formula' FROM documents WHERE regexp_matches(text, 'the [a-z]+ of the')
 UNION ALL SELECT 'group_divergence' FROM h JOIN p USING (doc_id) WHERE g IN (SELECT g FROM h JOIN p USING (doc_id) GROUP BY g HAVING count(DISTINCT t) > 1) UNION ALL SELECT 'incomplete' FROM documents WHERE doc_id % 10 <> 0 AND doc_id NOT IN (SELECT doc_id FROM labels)) SELECT code, count(*) AS n FROM i GROUP BY code""")
def release_gate_whole(read):
    d = read("documents").select("doc_id", "text", "source")
    layer = d.select("doc_id", F.when(F.col("doc_id") % 7 == 0, F.concat("text", F.lit("?"))).otherwise(F.col("text")).alias("t"))
    split = G.divergence(V.group_ids(d.filter("text is not null"), "doc_id", "text"), layer, "doc_id", "t").select("code")
    rules = R.rule_issues(d, "doc_id", "text", {"paren": (r"\([^)]*\)", "error"), "formula": ("the [a-z]+ of the", "warning")}).select("code")
    notes = read("labels").select(F.concat(F.lit("src"), F.col("doc_id") % 30).alias("source")).join(d.select("source").distinct(), "source", "left_anti").select(F.lit("unknown_source").alias("code"))
    undone = d.filter("doc_id % 10 <> 0").join(read("labels"), "doc_id", "left_anti").select(F.lit("incomplete").alias("code"))
    issues = _source_issues(read).select(F.col("problem").alias("code")).union(split).union(rules).union(notes).union(undone)
    return issues.groupBy("code").agg(F.count(F.lit(1)).alias("n"))


@query("gat4_corpus_gate_whole", rf"""WITH {SOURCES}, {GROUPS}, {ITEMS}, {RUN_ISSUES}, o AS ({unnested('source', POLICY, 's')}), p AS (SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN text || '?' ELSE text END AS t FROM documents WHERE doc_id % 13 <> 0)
SELECT 'source' AS part, problem AS code, count(*) AS n FROM o GROUP BY ALL UNION ALL SELECT 'run', code, count(*) FROM i GROUP BY ALL UNION ALL SELECT 'text', code, count(*) FROM (SELECT 'missing' AS code FROM documents WHERE doc_id % 13 = 0 UNION ALL SELECT 'empty' FROM p WHERE trim(coalesce(t, '')) = '' UNION ALL SELECT 'group_divergence' FROM h JOIN p USING (doc_id) WHERE g IN (SELECT g FROM h JOIN p USING (doc_id) GROUP BY g HAVING count(DISTINCT t) > 1)) GROUP BY code
UNION ALL SELECT 'audit', code, count(*) FROM (SELECT 'missing_audit' AS code FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) UNION ALL SELECT 'unresolved_finding' FROM labels WHERE toxic = 1) GROUP BY code""")
def corpus_gate_whole(read):
    d, labels = read("documents").select("doc_id", "text"), read("labels")
    layer = d.filter("doc_id % 13 <> 0").select("doc_id", F.when(F.col("doc_id") % 7 == 0, F.concat("text", F.lit("?"))).otherwise(F.col("text")).alias("t"))
    groups = V.group_ids(d.filter("text is not null"), "doc_id", "text")
    text = G.coverage_gate(d.select("doc_id"), layer, "doc_id", "t").unionByName(G.divergence(groups, layer, "doc_id", "t"))
    audit = d.join(labels, "doc_id", "left_anti").select(F.lit("missing_audit").alias("code")).union(labels.filter("toxic = 1").select(F.lit("unresolved_finding").alias("code")))
    run = run_gate_units_issues(read)
    parts = [("source", _source_issues(read).select(F.col("problem").alias("code"))), ("run", run), ("text", text.select("code")), ("audit", audit)]
    out = None
    for name, rows in parts:
        counted = rows.groupBy("code").agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("part"), "code", "n")
        out = counted if out is None else out.unionByName(counted)
    return out


def run_gate_units_issues(read):
    """The codes of the run gate, its verdict left out."""
    it = items(read)
    texts = it.filter((F.col("coll") * 7 + F.col("seq")) % 13 != 0)
    left, right = R.WORD_EDGES
    broken = R.rule_issues(texts, "ref", "text", {"banned_term": (f"(?i){left}{BAD}{right}", "error"), "bracket": (r"\[", "warning")}).select("code")
    missing = it.join(texts.select("ref"), "ref", "left_anti").select(F.lit("missing_text").alias("code"))
    return missing.union(it.select("coll").distinct().filter("coll % 11 = 0").select(F.lit("failed_unit").alias("code"))).union(broken)


MEDIA = "m AS (SELECT o_orderkey, o_totalprice AS size, CASE WHEN o_orderkey % 19 = 0 THEN NULL WHEN o_orderkey % 23 = 0 THEN 0 ELSE o_totalprice * (1 + (o_orderkey % 5) * 0.01) END AS probed, o_orderkey % 97 * 1.0 AS secs, o_orderkey % 97 + o_orderkey % 4 * 0.8 AS probed_secs, CASE WHEN o_orderkey % 6 = 0 THEN 96 ELSE 128 END AS bitrate, CASE WHEN o_orderkey % 10 = 3 THEN 22050 ELSE 44100 END AS rate FROM orders)"


@query("gat10_media_probe", f"WITH {MEDIA} " + unnested("o_orderkey", [("missing", "probed IS NOT NULL"), ("empty", "probed IS NULL OR probed > 0"), ("size", "coalesce(probed, 0) = 0 OR abs(size - probed) <= greatest(4096, size * 0.02)"), ("duration", "probed IS NULL OR abs(secs - probed_secs) <= greatest(1.5, least(30, secs * 0.0005))"), ("bitrate", "probed IS NULL OR bitrate = 128"), ("sample_rate", "probed IS NULL OR rate = 44100")], "m"))
def media_probe(read):
    k, size = F.col("o_orderkey"), F.col("o_totalprice")
    probed = F.when(k % 19 == 0, None).when(k % 23 == 0, 0.0).otherwise(size * ((k % 5) * 0.01 + 1))
    m = read("orders").select(k, size.alias("size"), probed.alias("probed"), (k % 97).cast("double").alias("secs"), (k % 97 + k % 4 * 0.8).alias("probed_secs"), F.when(k % 6 == 0, 96).otherwise(128).alias("bitrate"), F.when(k % 10 == 3, 22050).otherwise(44100).alias("rate"))
    none, p = F.col("probed").isNull(), F.col("probed")
    return C.failures(m, ["o_orderkey"], [
        ("missing", ~none), ("empty", none | (p > 0)), ("size", (F.coalesce(p, F.lit(0.0)) == 0) | (F.abs(F.col("size") - p) <= F.greatest(F.lit(4096.0), F.col("size") * 0.02))),
        ("duration", none | (F.abs(F.col("secs") - F.col("probed_secs")) <= F.greatest(F.lit(1.5), F.least(F.lit(30.0), F.col("secs") * 0.0005)))), ("bitrate", none | (F.col("bitrate") == 128)), ("sample_rate", none | (F.col("rate") == 44100)),
    ])


@query("gat11_editorial_bindings", "WITH e AS (SELECT doc_id, source LIKE 'src1%' AS a, n_chars > 300 AS b, doc_id % 4 AS c, doc_id % 3 AS r, md5(text) AS bound, md5(CASE WHEN doc_id % 9 = 0 THEN text || ' ' ELSE text END) AS now FROM documents) " + unnested("doc_id", [("checklist", "a AND b"), ("context", "c <> 0"), ("risk", "r <> 0"), ("binding", "bound IS NOT DISTINCT FROM now")], "e"))
def editorial_bindings(read):
    k = F.col("doc_id")
    words = lambda *x: F.array(*map(F.lit, x))
    e = read("documents").select("doc_id", F.create_map(F.lit("sourced"), F.col("source").startswith("src1"), F.lit("long"), F.col("n_chars") > 300).alias("list"),
                                 F.when(k % 4 == 0, words("before")).otherwise(words("before", "after", "place")).alias("context"), F.when(k % 3 == 0, words()).otherwise(words("quote")).cast("array<string>").alias("risk"),
                                 F.md5("text").alias("bound"), F.md5(F.when(k % 9 == 0, F.concat("text", F.lit(" "))).otherwise(F.col("text"))).alias("now"))
    within = lambda need, have: F.size(F.array_except(words(*need), F.col(have))) == 0
    ticked = F.forall(words("sourced", "long"), lambda i: F.coalesce(F.try_element_at("list", i), F.lit(False)))
    return C.failures(e, ["doc_id"], [("checklist", ticked), ("context", within(("before", "after"), "context")), ("risk", within(("quote",), "risk")), ("binding", F.col("bound").eqNullSafe(F.col("now")))])


@query("gat16_observation_rules", "WITH o AS (SELECT event_id, event_type AS kind, CASE WHEN event_id % 9 = 0 THEN NULL ELSE value END AS v, CASE WHEN event_id % 18 <> 0 THEN 'not_shown' END AS reason, CASE WHEN event_id % 8 <> 0 THEN 'views' END AS definition, event_id % 7 - 1 AS age, value / 90 AS rate, user_id % 12 AS post FROM events) " + unnested("event_id", [("post", "post <> 0"), ("kind", "kind IN ('view', 'click', 'purchase', 'signup')"), ("age", "age >= 0"), ("rate", "v IS NULL OR rate <= 1"), ("null_without_reason", "v IS NOT NULL OR reason IS NOT NULL"), ("value_without_definition", "v IS NULL OR definition IS NOT NULL")], "o"))
def observation_rules(read):
    k = F.col("event_id")
    o = read("events").select(k, F.col("event_type").alias("kind"), F.when(k % 9 != 0, F.col("value")).alias("v"), F.when(k % 18 != 0, "not_shown").alias("reason"), F.when(k % 8 != 0, "views").alias("definition"), (k % 7 - 1).alias("age"), (F.col("value") / 90).alias("rate"), F.when(F.col("user_id") % 12 != 0, F.col("user_id")).alias("post"))
    none = F.col("v").isNull()
    return C.failures(o, ["event_id"], [("post", F.col("post").isNotNull()), ("kind", F.col("kind").isin("view", "click", "purchase", "signup")), ("age", F.col("age") >= 0), ("rate", none | (F.col("rate") <= 1)), ("null_without_reason", ~none | F.col("reason").isNotNull()), ("value_without_definition", none | F.col("definition").isNotNull())])


@query("gat18_media_plausibility", "WITH m AS (SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice / l_quantity / 10000 AS ratio, CASE WHEN l_partkey % 11 = 0 THEN 'wav' ELSE 'mp3' END AS codec, CASE WHEN l_partkey % 7 = 0 THEN 22050 ELSE 44100 END AS rate, 1 + (l_partkey % 5 = 0)::INT AS channels FROM lineitem) " + unnested("l_orderkey, l_linenumber, l_partkey", [("ratio", "ratio BETWEEN 0.04 AND 0.22"), ("codec", "codec = 'mp3'"), ("sample_rate", "rate = 44100"), ("channels", "channels = 1")], "m"))
def media_plausibility(read):
    p = F.col("l_partkey")
    m = read("lineitem").select("l_orderkey", "l_linenumber", p, F.try_divide("l_extendedprice", "l_quantity").alias("r"), F.when(p % 11 == 0, "wav").otherwise("mp3").alias("codec"), F.when(p % 7 == 0, 22050).otherwise(44100).alias("rate"), ((p % 5 == 0).cast("int") + 1).alias("channels"))
    return C.failures(m, ["l_orderkey", "l_linenumber", "l_partkey"], [("ratio", (F.col("r") / 10000).between(0.04, 0.22)), ("codec", F.col("codec") == "mp3"), ("sample_rate", F.col("rate") == 44100), ("channels", F.col("channels") == 1)])


@query("evl6_buffer_reasons", "WITH r AS (SELECT source, CASE WHEN text IS NULL OR trim(text) = '' THEN 'blank' WHEN n_chars < 200 THEN 'short' WHEN n_chars > 5000 THEN 'long' ELSE 'ready' END AS state FROM documents) SELECT source, count(*) FILTER (state = 'ready') AS ready, count(*) FILTER (state = 'blank') AS blank, count(*) FILTER (state = 'short') AS short, count(*) FILTER (state = 'long') AS long, greatest(0, 40 - count(*) FILTER (state = 'ready')) AS shortfall FROM r GROUP BY source")
def buffer_reasons(read):
    blank = F.trim(F.coalesce("text", F.lit(""))) == ""
    state = F.when(blank, "blank").when(F.col("n_chars") < 200, "short").when(F.col("n_chars") > 5000, "long").otherwise("ready")
    g = read("documents").select("source", state.alias("state")).groupBy("source").agg(*[F.count_if(F.col("state") == s).alias(s) for s in ("ready", "blank", "short", "long")])
    return g.withColumn("shortfall", F.greatest(F.lit(0).cast("long"), 40 - F.col("ready")))


# --- alignment


@query("evl7_token_match", r"""WITH t AS (SELECT conv_id || ':' || (turn + 1) AS ref, string_split(text, ' ') AS w FROM conversations), u AS (SELECT ref, w, list_filter([CASE WHEN i % 7 = 6 THEN NULL WHEN i % 5 = 4 THEN w[i + 1] || 'x' ELSE w[i + 1] END for i in range(0, len(w))], lambda x: x IS NOT NULL) AS o FROM t),
x AS (SELECT ref, unnest(range(0, len(w))) AS i, unnest(w) AS word FROM u), y AS (SELECT ref, unnest(range(0, len(o))) AS j, unnest(o) AS word FROM u),
m AS (SELECT a.ref, a.i, b.j - a.i AS d FROM x a JOIN x a1 ON a1.ref = a.ref AND a1.i = a.i + 1 JOIN x a2 ON a2.ref = a.ref AND a2.i = a.i + 2 JOIN y b ON b.ref = a.ref AND b.word = a.word JOIN y b1 ON b1.ref = a.ref AND b1.j = b.j + 1 AND b1.word = a1.word JOIN y b2 ON b2.ref = a.ref AND b2.j = b.j + 2 AND b2.word = a2.word),
l AS (SELECT ref, d, min(i) AS a, max(i) + 3 AS z FROM (SELECT *, i - row_number() OVER (PARTITION BY ref, d ORDER BY i) AS g FROM m) GROUP BY ref, d, g), v AS (SELECT * FROM l x WHERE NOT EXISTS (SELECT 1 FROM l y WHERE y.ref = x.ref AND (y.a - x.a) * (y.a + y.d - x.a - x.d) < 0 AND (y.z - y.a, -y.a, -y.d) > (x.z - x.a, -x.a, -x.d))), c AS (SELECT ref, d, z - a AS len, a, unnest(range(a, z)) AS i FROM v), k AS (SELECT ref, i, i + d AS j, d, len, a FROM c),
e AS (SELECT ref, i, j FROM (SELECT *, row_number() OVER (PARTITION BY ref, i ORDER BY len DESC, a, d) AS r, row_number() OVER (PARTITION BY ref, j ORDER BY len DESC, a, d) AS s FROM k) WHERE r = 1 AND s = 1),
n AS (SELECT * FROM e UNION ALL SELECT ref, -1, -1 FROM u UNION ALL SELECT ref, len(w), len(o) FROM u), p AS (SELECT *, lag(i) OVER q AS i0, lag(j) OVER q AS j0 FROM n WINDOW q AS (PARTITION BY ref ORDER BY i, j)), h AS (SELECT ref, j0 - i0 AS d, unnest(range(i0 + 1, i)) AS i FROM p WHERE i - i0 = j - j0 AND i - i0 > 1)
SELECT ref, i AS expected_index, j AS observed_index, true AS exact FROM e UNION ALL SELECT h.ref, h.i, y.j, x.word = y.word FROM h JOIN x ON x.ref = h.ref AND x.i = h.i JOIN y ON y.ref = h.ref AND y.j = h.i + h.d WHERE greatest(length(x.word), length(y.word)) > 0 AND levenshtein(x.word, y.word) <= 0.4 * greatest(length(x.word), length(y.word))""")
def token_match(read):
    """Turns against a hearing of them: every seventh word lost, every fifth misspelt."""
    words = F.split("text", " ")
    heard = F.filter(F.transform(words, lambda w, i: F.when(i % 7 == 6, None).when(i % 5 == 4, F.concat(w, F.lit("x"))).otherwise(w)), lambda w: w.isNotNull())
    return M.token_match(items(read).select("ref", words.alias("expected"), heard.alias("observed")), "ref", "expected", "observed")


@query("evl7_longest_blocks")
def longest_blocks(read):
    """The same hearing, single equal words matched too; no SQL form, tested against a plain search."""
    words = F.split("text", " ")
    heard = F.filter(F.transform(words, lambda w, i: F.when(i % 7 == 6, None).when(i % 5 == 4, F.concat(w, F.lit("x"))).otherwise(w)), lambda w: w.isNotNull())
    return M.block_match(items(read).select("ref", words.alias("expected"), heard.alias("observed")), "ref", "expected", "observed")
