"""Queries of the gates, remediation and clause operators."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from corpusloom.operators import contracts as C
from corpusloom.operators import folds
from corpusloom.operators import gates as G
from corpusloom.operators import resolve as V
from corpusloom.operators import rules as R
from corpusloom.plans.base import ITEMS, items, query
from corpusloom.plans.sequences import fold_sql

RULES = {"pipe": (r" \| ", "warning"), "paren": (r"\([^)]*\)", "error")}
FORMULA = {"formula": (r"\bthe [a-z]+ of the\b", "warning")}
#: A proposed layer of texts: some left out, some blank, some changed.
LAYER = "p AS (SELECT doc_id, lang, CASE WHEN doc_id % 11 = 0 THEN ' ' WHEN doc_id % 7 = 0 THEN text || '?' ELSE text END AS t FROM documents WHERE doc_id % 13 <> 0)"
COVER = "SELECT doc_id, 'missing' AS code, 'error' AS severity FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM p) UNION ALL SELECT doc_id, 'empty', 'error' FROM p WHERE trim(coalesce(t, '')) = ''"
RULED = r"SELECT doc_id, 'pipe', 'warning' FROM p WHERE contains(t, ' | ') UNION ALL SELECT doc_id, 'paren', 'error' FROM p WHERE regexp_matches(t, '\([^)]*\)')"
GROUPS = r"h0 AS (SELECT doc_id, sha256(trim(regexp_replace(nfc_normalize(text), '[\s\x0B\x{85}\p{Z}\x1C-\x1F]+', ' ', 'g'))) AS g FROM documents), h AS (SELECT doc_id, g FROM h0 QUALIFY count(*) OVER (PARTITION BY g) > 1 AND g IS NOT NULL)"
SPLIT = "SELECT doc_id, 'group_divergence', 'error' FROM h JOIN p USING (doc_id) WHERE t IS NOT NULL AND g IN (SELECT g FROM h JOIN p USING (doc_id) GROUP BY g HAVING count(DISTINCT t) > 1)"
FORMULAS = r"SELECT doc_id, 'formula', 'warning' FROM p WHERE regexp_matches(t, '\bthe [a-z]+ of the\b')"


def _layer(read):
    d = read("documents").filter("doc_id % 13 <> 0")
    t = F.when(F.col("doc_id") % 11 == 0, " ").when(F.col("doc_id") % 7 == 0, F.concat("text", F.lit("?"))).otherwise(F.col("text"))
    return d.select("doc_id", "lang", t.alias("t"))


def _groups(read):
    return V.duplicate_groups(read("documents").filter("text is not null"), "doc_id", "text")


def _memberships(read):
    """Every row's group; divergence and closure need no sizes, as a lone row neither differs nor adds any."""
    return V.group_ids(read("documents").filter("text is not null"), "doc_id", "text")


def _ids(read):
    return read("documents").select("doc_id")


@query("gat3_publication_gate", f"WITH {LAYER} {COVER} UNION ALL {RULED}")
def publication_gate(read):
    return G.text_gate(_ids(read), _layer(read), "doc_id", "t", RULES)


@query("gat4_corpus_gate", f"WITH {LAYER}, {GROUPS} {COVER} UNION ALL {RULED} UNION ALL {SPLIT} UNION ALL SELECT doc_id, 'missing_audit', 'error' FROM p WHERE doc_id NOT IN (SELECT doc_id FROM labels) UNION ALL SELECT doc_id, 'unresolved_finding', 'error' FROM labels WHERE toxic = 1")
def corpus_gate(read):
    layer, labels = _layer(read), read("labels")
    error = F.lit("error").alias("severity")
    unaudited = layer.join(labels, "doc_id", "left_anti").select("doc_id", F.lit("missing_audit").alias("code"), error)
    unresolved = labels.filter("toxic = 1").select("doc_id", F.lit("unresolved_finding").alias("code"), error)
    return G.text_gate(_ids(read), layer, "doc_id", "t", RULES, _memberships(read)).unionByName(unaudited).unionByName(unresolved)


@query("gat5_second_language_gate", f"WITH {LAYER}, {GROUPS} {COVER} UNION ALL {SPLIT} UNION ALL SELECT doc_id, 'missing_script', 'error' FROM p WHERE NOT regexp_matches(t, '[a-z]') UNION ALL SELECT doc_id, 'forbidden_script', 'error' FROM p WHERE regexp_matches(t, '[a-z]') AND regexp_matches(t, '[éèê]')")
def second_language_gate(read):
    layer = _layer(read)
    script = layer.filter("t is not null").select("doc_id", R.script_check(F.col("t"), "[a-z]", "[éèê]").alias("code"), F.lit("error").alias("severity")).filter("code <> 'ok'")
    return G.coverage_gate(_ids(read), layer, "doc_id", "t").unionByName(G.divergence(_memberships(read), layer, "doc_id", "t")).unionByName(script)


@query("gat6_release_gate", f"WITH {LAYER}, {GROUPS}, i AS ({COVER} UNION ALL {RULED} UNION ALL {SPLIT} UNION ALL {FORMULAS}) SELECT code, severity, count(*) AS n FROM i GROUP BY code, severity")
def release_gate(read):
    issues = G.text_gate(_ids(read), _layer(read), "doc_id", "t", {**RULES, **FORMULA}, _memberships(read))
    return issues.groupBy("code", "severity").agg(F.count(F.lit(1)).alias("n"))


@query("gat20_candidate_gate", rf"WITH {LAYER}, {GROUPS} {COVER} UNION ALL {SPLIT} UNION ALL SELECT DISTINCT doc_id, 'banned:' || lower(w), 'error' FROM (SELECT doc_id, unnest(regexp_extract_all(t, '(?i)\b(with|that)\b')) AS w FROM p)")
def candidate_gate(read):
    layer = _layer(read)
    return G.coverage_gate(_ids(read), layer, "doc_id", "t").unionByName(G.divergence(_memberships(read), layer, "doc_id", "t")).unionByName(G.term_issues(layer, "doc_id", "t", ["with", "that"]))


@query("res5_group_triage", f"WITH {LAYER}, {GROUPS}, x AS (SELECT g, min(doc_id) AS first, count(*) AS members, count(DISTINCT t) AS options FROM h JOIN p USING (doc_id) GROUP BY g), o AS (SELECT DISTINCT g FROM h WHERE doc_id % 5 = 0) SELECT first, members, options, CASE WHEN o.g IS NOT NULL THEN 'policy' WHEN options <= 1 THEN 'invariant' ELSE 'work_item' END AS status FROM x LEFT JOIN o USING (g)")
def group_triage(read):
    groups = _groups(read)
    return G.group_triage(groups, _layer(read), groups.filter("doc_id % 5 = 0").select("group_id"), "doc_id", "t")


@query("res9_remediation_targets", f"""WITH {LAYER}, {GROUPS}, i AS (SELECT * FROM ({COVER} UNION ALL {RULED}) WHERE severity = 'error'), c AS (SELECT doc_id, string_agg(DISTINCT code, ',' ORDER BY code) AS codes FROM i GROUP BY doc_id)
SELECT doc_id, false AS closure_only, codes FROM c UNION ALL SELECT doc_id, true, '' FROM h WHERE g IN (SELECT g FROM h JOIN c USING (doc_id)) AND doc_id NOT IN (SELECT doc_id FROM c)""")
def remediation_targets(read):
    return G.remediation_targets(G.text_gate(_ids(read), _layer(read), "doc_id", "t", RULES), _memberships(read), "doc_id")


@query("con3_elliptical_ground", "WITH d AS (SELECT doc_id, replace(text, '.', '') AS t FROM documents), q AS (SELECT doc_id, lower(t) AS t, lower(substr(t, 1, 12)) AS a, lower(substr(t, 40, 12)) AS b FROM d), o AS (SELECT doc_id, t, CASE WHEN doc_id % 5 = 0 THEN b ELSE a END AS a, CASE WHEN doc_id % 5 = 0 THEN a ELSE b END AS b FROM q) SELECT doc_id, coalesce(length(trim(a)) + length(trim(b)) > 0 AND contains(t, a) AND contains(substr(t, strpos(t, a) + length(a)), b), false) AS grounded FROM o")
def elliptical_ground(read):
    d = read("documents").select("doc_id", F.replace("text", F.lit("."), F.lit("")).alias("t"))
    a, b = F.substring("t", 1, 12), F.substring("t", 40, 12)
    ground = F.when(F.col("doc_id") % 5 == 0, F.concat(b, F.lit("..."), a)).otherwise(F.concat(a, F.lit("..."), b))
    return d.select("doc_id", G.elliptical(F.col("t"), ground).alias("grounded"))


@query("con5_spoken_review", """WITH f AS (SELECT doc_id, quality = 0 AS has, text, CASE WHEN doc_id % 6 = 0 THEN 'whole text' WHEN doc_id % 5 = 0 THEN '#####' ELSE substr(text, 1, 9) END AS quote, doc_id % 4 = 0 AS passed FROM labels JOIN documents USING (doc_id))
SELECT doc_id, problem FROM (SELECT doc_id, unnest([CASE WHEN has = passed THEN 'verdict_mismatch' END, CASE WHEN has AND quote = 'whole text' THEN 'generic_quote' END, CASE WHEN has AND NOT coalesce(contains(text, quote), false) THEN 'not_in_text' END]) AS problem FROM f) WHERE problem IS NOT NULL""")
def spoken_review(read):
    quote = F.when(F.col("doc_id") % 6 == 0, "whole text").when(F.col("doc_id") % 5 == 0, "#####").otherwise(F.substring("text", 1, 9))
    f = read("labels").join(read("documents").select("doc_id", "text"), "doc_id").withColumn("quote", quote)
    has = F.col("quality") == 0
    checks = [("verdict_mismatch", has != (F.col("doc_id") % 4 == 0)), ("generic_quote", ~has | ~F.lower("quote").isin("whole text", "entire text")), ("not_in_text", ~has | F.contains("text", "quote"))]
    return C.failures(f, ["doc_id"], checks)


@query("con8_remediation_decisions", f"""WITH {GROUPS}, d AS (SELECT doc_id, doc_id % 3 = 0 AS applied, CASE WHEN doc_id % 6 = 0 OR doc_id % 10 = 1 THEN text || '!' ELSE text END AS t, text FROM documents WHERE doc_id % 9 <> 0 AND text IS NOT NULL)
SELECT doc_id, 'undecided' AS problem FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM d) UNION ALL SELECT doc_id, CASE WHEN applied THEN 'applied_without_change' ELSE 'changed_without_applying' END FROM d WHERE applied <> (t <> text)
UNION ALL SELECT doc_id, 'group_divergence' FROM h JOIN d USING (doc_id) WHERE g IN (SELECT g FROM h JOIN d USING (doc_id) GROUP BY g HAVING count(DISTINCT t) > 1)""")
def remediation_decisions(read):
    docs, k = read("documents").select("doc_id", "text"), F.col("doc_id")
    targets = docs.join(_memberships(read).select("doc_id", "group_id"), "doc_id", "left")
    new = F.when((k % 6 == 0) | (k % 10 == 1), F.concat("text", F.lit("!"))).otherwise(F.col("text"))
    decisions = docs.filter("doc_id % 9 <> 0 and text is not null").select("doc_id", (k % 3 == 0).alias("applied"), new.alias("new_text"))
    return G.remediation_issues(targets, decisions, "doc_id")


WORDS = "w AS (SELECT user_id, event_type, event_id, ts, event_id % 23 <> 1 AS mapped, floor(epoch(ts))::BIGINT AS s, floor(epoch(ts))::BIGINT + event_id % 3 * 4000 AS e FROM events)"


@query("gat7_timeline_gate", f"""WITH {WORDS}, l AS (SELECT *, lag(e) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM w), i AS (SELECT user_id, event_type, avg(mapped::INT) AS r FROM l GROUP BY ALL),
u AS (SELECT user_id, avg(mapped::INT) AS r, bool_or(coalesce(s < p - 0.002, false)) AS late, bool_or(e > 1706500000 + user_id * 10000 + 0.002) AS beyond FROM l GROUP BY user_id), m AS (SELECT user_id, min(r) AS part FROM i GROUP BY user_id)
SELECT user_id, problem FROM (SELECT user_id, unnest([CASE WHEN u.r < 0.95 THEN 'unit_coverage' END, CASE WHEN part < 0.9 THEN 'item_coverage' END, CASE WHEN late THEN 'order' END, CASE WHEN beyond THEN 'bounds' END]) AS problem FROM u JOIN m USING (user_id)) WHERE problem IS NOT NULL""")
def timeline_gate(read):
    ev = read("events").select("user_id", "event_type", "event_id", "ts", (F.col("event_id") % 23 != 1).alias("mapped"), F.unix_timestamp("ts").alias("start"), (F.col("user_id") * 10000 + 1706500000).alias("duration"))
    return G.timeline_gate(ev.withColumn("end", F.col("start") + F.col("event_id") % 3 * 4000), "user_id", "event_type", ["ts", "event_id"])


@query("gat8_manifest_gate", f"""WITH {ITEMS}, m AS (SELECT coll FROM items GROUP BY coll) SELECT coll, problem FROM (SELECT coll, unnest(CASE WHEN coll % 8 = 7 THEN ['not_listed'] ELSE [CASE WHEN coll % 3 = 0 THEN 'text' END, CASE WHEN coll % 4 = 0 THEN 'chars' END, CASE WHEN coll % 5 = 0 THEN 'count' END] END) AS problem FROM m) WHERE problem IS NOT NULL""")
def manifest_gate(read):
    it, k = items(read), F.col("coll")
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "text"))), lambda x: x["text"]), "\n")
    kept = it.groupBy("coll").agg(joined.alias("t"), F.count(F.lit(1)).alias("c")).filter("coll % 8 <> 7")
    digest = F.when(k % 3 == 0, "0").otherwise(F.sha2("t", 256))
    stored = kept.select("coll", digest.alias("digest"), (F.length("t") + (k % 4 == 0).cast("int")).alias("chars"), (F.col("c") + (k % 5 == 0).cast("int")).alias("n"))
    return G.manifest_gate(it, stored, "coll", "seq", "text")


@query("gat9_catalog_gate", """WITH s AS (SELECT l_orderkey, max(n) AS times, sum(n) AS n FROM (SELECT l_orderkey, l_partkey, count(*) AS n FROM lineitem GROUP BY ALL) GROUP BY l_orderkey), p AS (SELECT l_orderkey, count(DISTINCT l_linenumber) AS places, max(l_linenumber) - min(l_linenumber) + 1 AS width FROM lineitem GROUP BY l_orderkey)
SELECT l_orderkey, problem FROM (SELECT l_orderkey, unnest([CASE WHEN times > 1 THEN 'repeated_segment' END, CASE WHEN places <> n OR width <> n THEN 'not_contiguous' END, CASE WHEN n <> l_orderkey % 5 + 1 THEN 'count' END]) AS problem FROM s JOIN p USING (l_orderkey)) WHERE problem IS NOT NULL""")
def catalog_gate(read):
    return G.catalog_gate(read("lineitem").withColumn("e", F.col("l_orderkey") % 5 + 1), "l_orderkey", "l_partkey", "l_linenumber", "e")


@query("gat11_editorial_checklist", """SELECT doc_id, 'sourced' AS item, 'not_true' AS problem FROM documents WHERE NOT coalesce(source LIKE 'src1%', false) UNION ALL SELECT doc_id, 'reviewed', 'absent' FROM documents WHERE doc_id % 4 = 0 UNION ALL SELECT doc_id, 'reviewed', 'not_true' FROM documents WHERE doc_id % 4 <> 0 AND NOT coalesce(n_chars > 300, false) UNION ALL SELECT doc_id, 'other', 'unknown_item' FROM documents WHERE doc_id % 4 = 0""")
def editorial_checklist(read):
    name = F.when(F.col("doc_id") % 4 == 0, "other").otherwise("reviewed")
    made = F.create_map(F.lit("sourced"), F.col("source").startswith("src1"), name, F.col("n_chars") > 300)
    return G.checklist_gate(read("documents"), "doc_id", made, ["sourced", "reviewed"])


@query("gat12_timing_eligibility", """WITH e AS (SELECT event_id, event_id % 7 * 0.5 AS hook, 2 + event_id % 11 AS quote, 10 + event_id % 13 AS quote_end, 15 + event_id % 17 AS ends FROM events)
SELECT event_id, problem FROM (SELECT event_id, unnest([CASE WHEN hook > 2 THEN 'late_hook' END, CASE WHEN quote < hook THEN 'quote_before_hook' END, CASE WHEN quote_end <= quote THEN 'empty_quote' END, CASE WHEN ends - quote_end < 1 THEN 'no_closing' END]) AS problem FROM e) WHERE problem IS NOT NULL""")
def timing_eligibility(read):
    k = F.col("event_id")
    e = read("events").select(k, (k % 7 * 0.5).alias("hook"), (k % 11 + 2).alias("quote"), (k % 13 + 10).alias("quote_end"), (k % 17 + 15).alias("ends"))
    return G.timing_issues(e, "event_id")


@query("gat13_caption_gate", f"""WITH {ITEMS}, c AS (SELECT ref, coll, string_split(text, ' ') AS w FROM items), m AS (SELECT ref, coll, len(w) AS n, (len(w) + 4) // 5 AS k FROM c)
SELECT ref, problem FROM (SELECT ref, unnest([CASE WHEN coll % 3 = 0 THEN 'text' END, CASE WHEN coll % 4 = 0 AND k > 1 THEN 'overlap' END, CASE WHEN k * 5 + (coll % 4 = 0)::INT > n + 4 THEN 'outside' END]) AS problem FROM m) WHERE problem IS NOT NULL""")
def caption_gate(read):
    it = items(read).select("ref", "coll", "text", F.split("text", " ").alias("w"))
    cues = it.select("ref", "coll", "w", F.explode(F.sequence(F.lit(0), F.ceil(F.size("w") / 5).cast("int") - 1)).alias("cue"))
    words = F.array_join(F.slice("w", F.col("cue") * 5 + 1, F.lit(5)), " ")
    shown = F.when((F.col("coll") % 3 == 0) & (F.col("cue") == 0), F.concat(words, F.lit("#"))).otherwise(words)
    end = (F.col("cue") + 1) * 5 + (F.col("coll") % 4 == 0).cast("int")
    captions = cues.select("ref", "cue", (F.col("cue") * 5).alias("start"), end.alias("end"), shown.alias("caption"))
    return G.caption_gate(captions, it.select("ref", "text", F.lit(0).alias("clip_start"), (F.size("w") + 4).alias("clip_end")), "ref")


@query("evl8_span_times", """WITH c AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS p, floor(epoch(ts))::BIGINT AS s, floor(epoch(ts))::BIGINT + event_id % 9 AS e FROM events)
SELECT user_id, p // 12 AS span, arg_min(s, p) AS start, arg_max(e, p) AS "end", count(*) AS n FROM c GROUP BY user_id, p // 12""")
def span_times(read):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    c = read("events").select("user_id", (F.row_number().over(w) - 1).alias("p"), F.unix_timestamp("ts").alias("start"), (F.unix_timestamp("ts") + F.col("event_id") % 9).alias("end"))
    return G.span_times(c.withColumn("span", F.floor(F.col("p") / 12)), ["user_id", "span"], "p")


CHARS = "SELECT conv_id AS k, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n, length(text)::BIGINT AS c FROM conversations"


@query("win9_fragment_resplit", fold_sql(CHARS, "(cnt >= 6 OR tot + r.c > 2500)").rsplit("\nSELECT k, unit", 1)[0] + """, g AS (SELECT *, max(unit) OVER (PARTITION BY k) AS m, count(*) OVER (PARTITION BY k) AS z FROM f)
SELECT k, CASE WHEN m = 0 AND z > 1 THEN (n > ceil(z / 2.0))::BIGINT ELSE unit END AS piece, count(*) AS n_items, sum(c)::BIGINT AS total FROM g GROUP BY ALL""")
def fragments(read):
    rows = items(read).select(F.col("coll").alias("k"), "seq", F.length("text").cast("long").alias("c"))
    return folds.unit_table(G.resplit(rows, ["k"], [F.col("seq")], "c", 6, 2500), ["k"], "c", "piece")


@query("win11_clause_merge", fold_sql("SELECT ref AS k, row_number() OVER (PARTITION BY ref ORDER BY i) AS n, length(p)::BIGINT AS c FROM (SELECT ref, i, trim(w[i]) AS p FROM (SELECT ref, w, unnest(range(1, len(w) + 1)) AS i FROM (SELECT conv_id || ':' || (turn + 1) AS ref, regexp_extract_all(text, '[^.,;:!?]+[.,;:!?]*') AS w FROM conversations))) WHERE p <> ''", "(tot + r.c + cnt > 180)"))
def clauses(read):
    parts = F.regexp_extract_all("text", F.lit("[^.,;:!?]+[.,;:!?]*"), F.lit(0))
    rows = items(read).select(F.col("ref").alias("k"), F.posexplode(parts).alias("i", "p")).withColumn("p", F.trim("p")).filter("p <> ''")
    packed = folds.fold_units(rows.select("k", "i", F.length("p").cast("long").alias("c")), ["k"], [F.col("i")], "c", folds.greedy(1_000_000, 180, 1))
    return folds.unit_table(packed, ["k"], "c")


@query("snk1_json_edition", f"WITH {ITEMS} SELECT coll, seq, json_object('ref', ref, 'role', role, 'text', text)::VARCHAR AS line FROM items")
def json_edition(read):
    return items(read).select("coll", "seq", F.to_json(F.struct("ref", "role", "text")).alias("line"))


@query("snk8_catalog_rows", """SELECT l_orderkey, CASE WHEN count(*) = 1 THEN 'Part of order ' ELSE 'Order ' END || l_orderkey AS title, 'Lines ' || min(l_linenumber) || '-' || max(l_linenumber) || chr(10) || string_agg(l_linenumber || ' part ' || l_partkey, chr(10) ORDER BY l_linenumber, l_partkey) AS description FROM lineitem GROUP BY l_orderkey""")
def catalog_rows(read):
    line = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey")))  # the chapters of one output
    lines = F.array_join(F.transform(line, lambda x: F.format_string("%d part %d", x["l_linenumber"], x["l_partkey"])), "\n")
    kind = F.when(F.count(F.lit(1)) == 1, "Part of order ").otherwise("Order ")
    title = F.concat(kind, F.col("l_orderkey").cast("string"))
    about = F.concat(F.format_string("Lines %d-%d\n", F.min("l_linenumber"), F.max("l_linenumber")), lines)
    return read("lineitem").groupBy("l_orderkey").agg(title.alias("title"), about.alias("description"))


@query("win15_chapter_points", """WITH RECURSIVE r AS MATERIALIZED (SELECT user_id AS k, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n, floor(epoch(ts))::BIGINT AS s, floor(epoch(ts))::BIGINT // 86400 AS day FROM events),
f AS (SELECT k, n, event_id, s, day, s + 40000 AS target, s AS kept, true AS point FROM r WHERE n = 1
 UNION ALL SELECT r.k, r.n, r.event_id, r.s, r.day, CASE WHEN r.s >= target THEN r.s + 40000 ELSE target END, CASE WHEN (r.day <> f.day OR r.s >= target) AND r.s - kept >= 3000 THEN r.s ELSE kept END, (r.day <> f.day OR r.s >= target) AND r.s - kept >= 3000 FROM f JOIN r ON r.k = f.k AND r.n = f.n + 1)
SELECT k, event_id, s FROM (SELECT *, count(*) FILTER (point) OVER (PARTITION BY k) AS points, max(s) OVER (PARTITION BY k) - min(s) OVER (PARTITION BY k) AS len FROM f) WHERE point AND points >= 3 AND len >= 90000""")
def chapters(read):
    ev = read("events").select(F.col("user_id").alias("k"), "event_id", "ts", F.unix_timestamp("ts").alias("s")).withColumns({"day": F.floor(F.col("s") / 86400), "e": F.col("s")})
    return folds.chapter_points(ev, ["k"], "day", [F.col("ts"), F.col("event_id")], "s", "e", 40000, 3000, 3, 90000).select("k", "event_id", "s")
