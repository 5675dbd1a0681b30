"""Queries on attempts, manifests, recorded media values and candidate texts."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from corpusloom.operators import contracts as C
from corpusloom.operators import gates as G
from corpusloom.operators import resolve as V
from corpusloom.operators import rules as R
from corpusloom.plans.base import query


@query("agg24_alignment_audit", """SELECT result, count(*) AS n FROM (SELECT CASE WHEN event_id % 7 = 1 THEN 'unmapped' WHEN value <= 5 THEN 'too_short' WHEN event_type = 'error' THEN 'bad_source' ELSE 'pass' END AS result FROM events) GROUP BY result""")
def audit(read):
    checks = [("unmapped", F.col("event_id") % 7 != 1), ("too_short", F.col("value") > 5), ("bad_source", F.col("event_type") != "error")]
    return read("events").groupBy(C.first_failure(checks).alias("result")).agg(F.count(F.lit(1)).alias("n"))


@query("con4_blind_audit", """SELECT doc_id, problem FROM (SELECT doc_id, unnest([CASE WHEN doc_id % 7 NOT BETWEEN 1 AND 5 THEN 'score_range' END, CASE WHEN doc_id % 4 = 3 THEN 'unknown_candidate' END]) AS problem FROM labels) WHERE problem IS NOT NULL""")
def blind_audit(read):
    code = F.concat(F.lit("c"), F.col("doc_id") % 4)
    return C.failures(read("labels"), ["doc_id"], [("score_range", (F.col("doc_id") % 7).between(1, 5)), ("unknown_candidate", code.isin("c0", "c1", "c2"))])


@query("con10_label_log", "SELECT doc_id, CASE WHEN toxic = 1 THEN text ELSE 'whole text' END AS label, CASE WHEN toxic = 1 THEN 'replaced_generic_label' END AS operation FROM labels JOIN documents USING (doc_id) WHERE toxic = 1 OR quality = 0")
def label_log(read):
    f = read("labels").filter("toxic = 1 or quality = 0").join(read("documents").select("doc_id", "text"), "doc_id")
    return V.canonical_labels(f.withColumn("label", F.lit("whole text")), F.col("toxic") == 1, "text", "label").select("doc_id", "label", "operation")


@query("con11_batch_collection", """WITH u AS (SELECT o_orderkey, o_custkey, o_orderkey % 9 = 0 AS gone, o_orderstatus = 'P' AS broken, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderkey % 1000 END AS tokens, o_totalprice / 1000 AS d FROM orders)
SELECT o_custkey, CASE WHEN bool_or(gone OR broken) THEN 'collected_with_failures' ELSE 'collected' END AS state, count(*) FILTER (gone) AS missing, count(*) FILTER (broken AND NOT gone) AS errors, coalesce(sum(coalesce(tokens, ceil(d * 25)::BIGINT)) FILTER (NOT gone AND NOT broken), 0)::BIGINT AS tokens FROM u GROUP BY o_custkey""")
def batch_collection(read):
    o = read("orders")
    units = o.select("o_orderkey", "o_custkey")
    usage = F.when(F.col("o_orderkey") % 4 != 0, F.col("o_orderkey") % 1000)
    results = o.filter("o_orderkey % 9 <> 0").select("o_orderkey", (F.col("o_orderstatus") == "P").alias("failed"), usage.alias("tokens"), (F.col("o_totalprice") / 1000).alias("seconds"))
    return C.collect_batch(units, results, "o_orderkey", "o_custkey")


@query("res8_exact_guard", "SELECT doc_id, CASE WHEN text IS NOT NULL AND doc_id % 5 = 0 THEN 'text_differs' WHEN doc_id % 3 = 0 THEN 'count_differs' ELSE 'applied' END AS status FROM documents")
def exact_guard(read):
    d = read("documents").select("doc_id", "text", (F.col("doc_id") % 3).alias("unresolved"))
    edits = d.select("doc_id", F.when(F.col("doc_id") % 5 == 0, F.concat("text", F.lit("?"))).otherwise(F.col("text")).alias("before"), F.greatest(F.col("unresolved"), F.lit(1)).alias("expected"))
    status = C.first_failure([("text_differs", F.col("text").eqNullSafe(F.col("before"))), ("count_differs", F.col("unresolved") == F.col("expected"))], "applied")
    return d.join(edits, "doc_id").select("doc_id", status.alias("status"))


@query("res11_first_passing_attempt", "SELECT user_id, min(event_id) FILTER (value > 50) AS event_id, arg_min(event_type, event_id) FILTER (value > 50) AS event_type FROM events GROUP BY user_id")
def first_passing(read):
    ev = read("events").withColumn("ok", F.col("value") > 50)
    return C.first_passing(ev, ["user_id"], "event_id", "ok", "event_type")


@query("res14_final_merge", "SELECT doc_id, CASE WHEN doc_id % 6 = 0 THEN upper(source) ELSE source END AS value, CASE WHEN doc_id % 12 = 6 THEN 'not_a_target' WHEN doc_id % 8 = 4 AND doc_id % 6 <> 0 THEN 'target_left_out' ELSE 'ok' END AS guard FROM documents")
def final_merge(read):
    d = read("documents").select("doc_id", "source")
    over = d.filter("doc_id % 6 = 0").select("doc_id", F.upper("source").alias("value"))
    targets = d.filter("doc_id % 12 = 0 or doc_id % 8 = 4").select("doc_id")
    return V.final_merge(d.withColumnRenamed("source", "value"), over, targets, "doc_id")


@query("res15_fragment_roll_up", "SELECT l_orderkey, count(*) AS parts, CASE WHEN bool_or(l_returnflag = 'R') THEN 'failed' WHEN bool_or(l_linestatus = 'O') THEN 'pending' ELSE 'joinable' END AS state FROM lineitem GROUP BY l_orderkey")
def roll_up(read):
    status = F.when(F.col("l_returnflag") == "R", "failed").when(F.col("l_linestatus") == "O", "pending").otherwise("complete")
    return C.roll_up(read("lineitem").withColumn("status", status), ["l_orderkey"], "status")


@query("gat1_source_gate", "SELECT source, problem FROM (SELECT source, unnest([CASE WHEN count(*) <> 50 THEN 'cardinality' END, CASE WHEN bool_or(trim(coalesce(text, '')) = '') THEN 'blank_text' END, CASE WHEN count(DISTINCT lang) < 2 THEN 'one_language' END]) AS problem FROM documents GROUP BY source) WHERE problem IS NOT NULL")
def source_gate(read):
    blank = F.trim(F.coalesce("text", F.lit(""))) == ""
    per = read("documents").groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.bool_or(blank).alias("blank"), F.count_distinct("lang").alias("langs"))
    return C.failures(per, ["source"], [("cardinality", F.col("n") == 50), ("blank_text", ~F.col("blank")), ("one_language", F.col("langs") >= 2)])


@query("gat10_media_drift", """WITH m AS (SELECT o_orderkey, o_totalprice AS size, o_totalprice * (1 + (o_orderkey % 5) * 0.01) AS probed, o_orderkey % 97 * 1.0 AS secs, o_orderkey % 97 + o_orderkey % 4 * 0.8 AS probed_secs FROM orders)
SELECT o_orderkey, problem FROM (SELECT o_orderkey, unnest([CASE WHEN NOT abs(size - probed) <= greatest(4096, size * 0.02) THEN 'size' END, CASE WHEN NOT abs(secs - probed_secs) <= greatest(1.5, least(30, secs * 0.0005)) THEN 'duration' END]) AS problem FROM m) WHERE problem IS NOT NULL""")
def media_drift(read):
    k, size = F.col("o_orderkey"), F.col("o_totalprice")
    m = read("orders").select(k, size.alias("size"), (size * ((k % 5) * 0.01 + 1)).alias("probed"), (k % 97).cast("double").alias("secs"), (k % 97 + k % 4 * 0.8).alias("probed_secs"))
    return G.media_drift(m, ["o_orderkey"], "size", "probed", "secs", "probed_secs")


@query("gat14_caption_identity", """WITH e AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS cue, event_id % 1000 AS s, event_type AS t FROM events)
SELECT user_id, cue, CASE WHEN cue % 9 = 0 THEN 'missing' WHEN s % 10 = 0 THEN 'timing' WHEN t = 'error' THEN 'text' END AS problem FROM e WHERE cue % 9 = 0 OR s % 10 = 0 OR t = 'error'""")
def caption_identity(read):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    e = read("events").select("user_id", F.row_number().over(w).cast("long").alias("cue"), (F.col("event_id") % 1000).alias("s"), F.col("event_type").alias("t"))
    written = e.filter("cue % 9 <> 0").select("user_id", "cue", F.when(F.col("s") % 10 == 0, F.col("s") + 1).otherwise(F.col("s")).alias("s2"), F.when(F.col("t") == "error", "").otherwise(F.col("t")).alias("t2"))
    both = e.join(written, ["user_id", "cue"], "full")
    problem = C.first_failure([("unexpected", F.col("s").isNotNull()), ("missing", F.col("s2").isNotNull()), ("timing", F.col("s") == F.col("s2")), ("text", F.col("t") == F.col("t2"))])
    return both.select("user_id", "cue", problem.alias("problem")).filter("problem <> 'pass'")


@query("gat19_input_drift", """SELECT doc_id, 'lang' AS name, lang AS stored, 'xx' AS current FROM documents WHERE doc_id % 10 = 0 UNION ALL SELECT doc_id, 'source', source, NULL FROM documents WHERE doc_id % 15 = 0""")
def input_drift(read):
    d = read("documents")
    stored = d.select("doc_id", F.create_map(F.lit("lang"), F.col("lang"), F.lit("source"), F.col("source")).alias("m"))
    lang = F.when(F.col("doc_id") % 10 == 0, "xx").otherwise(F.col("lang"))
    now = F.when(F.col("doc_id") % 15 == 0, F.create_map(F.lit("lang"), lang)).otherwise(F.create_map(F.lit("lang"), lang, F.lit("source"), F.col("source")))
    return C.map_drift(stored, d.select("doc_id", now.alias("m")), "doc_id", "m")


@query("snk7_report_lines", r"""SELECT code, severity, severity || ' ' || code || ': ' || count(*) AS line FROM (SELECT 'pipe' AS code, 'warning' AS severity FROM documents WHERE contains(text, ' | ') UNION ALL SELECT 'paren', 'error' FROM documents WHERE regexp_matches(text, '\([^)]*\)')) GROUP BY code, severity""")
def report_lines(read):
    issues = R.rule_issues(read("documents"), "doc_id", "text", {"pipe": (r" \| ", "warning"), "paren": (r"\([^)]*\)", "error")})
    counts = issues.groupBy("code", "severity").agg(F.count(F.lit(1)).alias("n"))
    return counts.select("code", "severity", F.format_string("%s %s: %d", "severity", "code", "n").alias("line"))
