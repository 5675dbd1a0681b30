"""Queries on interval and quote joins, glossaries, schedules, scopes and response contracts."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from corpusloom.operators import address as A
from corpusloom.operators import contracts as C
from corpusloom.operators import folds, timeline
from corpusloom.operators import matching as M
from corpusloom.operators import resolve as V
from corpusloom.operators import rules as R
from corpusloom.plans.base import ITEMS, LINE_ORDER, items, query


@query("jon6_interval_overlap", """WITH e AS (SELECT user_id, event_id, event_type, floor(epoch(ts))::BIGINT AS s FROM events), w AS (SELECT user_id, event_id, s, s + event_id % 5000 AS e FROM e), p AS (SELECT user_id, event_id, s, s + 40000 AS e FROM e WHERE event_type = 'purchase')
SELECT w.user_id, w.event_id AS word_id, p.event_id AS span_id FROM w JOIN p ON w.user_id = p.user_id AND w.s < p.e AND p.s < w.e AND w.s < w.e""")
def overlap(read):
    ev = read("events").select("user_id", F.col("event_id").alias("id"), F.unix_timestamp("ts").alias("start"), "event_type")
    words = ev.select("user_id", "id", "start", (F.col("start") + F.col("id") % 5000).alias("end"))
    spans = ev.filter("event_type = 'purchase'").select("user_id", "id", "start", (F.col("start") + 40000).alias("end"))
    return M.interval_overlap(words, spans, ["user_id"], 40000).select("user_id", F.col("left_id").alias("word_id"), F.col("right_id").alias("span_id"))


@query("jon8_issue_to_finding", """WITH f AS (SELECT o_custkey AS k, o_orderpriority AS kind, o_orderkey AS id FROM orders), c AS (SELECT k, kind, count(*) AS n, min(id) AS id FROM f GROUP BY ALL), i AS (SELECT c_custkey AS k, p AS kind FROM customer, (SELECT DISTINCT o_orderpriority AS p FROM orders))
SELECT i.k, i.kind, CASE WHEN n IS NULL THEN 'missing' WHEN n > 1 THEN 'ambiguous' ELSE 'matched' END AS status, CASE WHEN n = 1 THEN id END AS finding_id FROM i LEFT JOIN c USING (k, kind)""")
def issue_to_finding(read):
    f = read("orders").select(F.col("o_custkey").alias("k"), F.col("o_orderpriority").alias("kind"), F.col("o_orderkey").alias("finding_id"))
    kinds = F.broadcast(f.select("kind").distinct())  # the enumeration of finding types
    issues = read("customer").select(F.col("c_custkey").alias("k")).crossJoin(kinds)
    return M.exactly_one(issues, f, ["k", "kind"], "finding_id").select("k", "kind", "status", "finding_id")


@query("jon9_same_ground_parallels", """WITH q AS (SELECT DISTINCT doc_id AS quote_id, source, array_to_string(string_split(text, ' ')[1:6], ' ') AS quote FROM documents JOIN labels USING (doc_id) WHERE toxic = 1 AND len(string_split(text, ' ')) >= 6)
SELECT quote_id, d.doc_id FROM q JOIN documents d ON d.source = q.source AND d.doc_id <> quote_id AND contains(d.text, quote) QUALIFY row_number() OVER (PARTITION BY quote_id ORDER BY d.doc_id) <= 8""")
def parallels(read):
    d = read("documents").select("source", "doc_id", "text")
    w = F.split("text", " ")
    marked = d.join(read("labels").filter("toxic = 1").select("doc_id"), "doc_id", "left_semi").filter(F.size(w) >= 6)
    quotes = marked.select("source", F.col("doc_id").alias("quote_id"), F.array_join(F.slice(w, 1, 6), " ").alias("quote"))
    return M.parallels(quotes, d, "source", "doc_id", "text", 6)


@query("jon11_records_of_passages", f"""WITH {ITEMS}, p AS (SELECT DISTINCT coll, 'p' || coll AS passage, 1 + coll % 2 AS a, 3 + coll % 3 AS b FROM items), n AS (SELECT coll, seq, role FROM items WHERE role <> 'user')
SELECT passage, n.coll || ':' || seq AS ref FROM p JOIN n ON n.coll = p.coll AND seq BETWEEN a AND b""")
def records_of_passages(read):
    it = items(read)
    passages = it.select("coll").distinct().select("coll", F.concat(F.lit("p"), "coll").alias("passage"), (F.col("coll") % 2 + 1).alias("a"), (F.col("coll") % 3 + 3).alias("b"))
    notes = it.filter("role <> 'user'").select("coll", "seq", "ref")
    return A.expand_range(passages, "a", "b").join(notes, ["coll", "seq"]).select("passage", "ref")


@query("prj11_identity_policy", "SELECT doc_id, CASE WHEN source LIKE 'src1%' THEN text ELSE replace(text, 'with', 'beside') END AS text FROM documents")
def identity_policy(read):
    return read("documents").select("doc_id", V.versioned_text(F.col("source"), "src1", F.col("text"), F.replace("text", F.lit("with"), F.lit("beside"))).alias("text"))


@query("win12_sliding_clauses", f"""WITH {ITEMS}, c AS (SELECT ref, string_split(text, ' ') AS w FROM items), x AS (SELECT ref, w, unnest(range(0, len(w))) AS i FROM c)
SELECT ref, i, array_to_string(w[greatest(0, least(i - 1, len(w) - 3)) + 1 : greatest(0, least(i - 1, len(w) - 3)) + 3], ' ') AS visible FROM x""")
def sliding(read):
    c = items(read).select("ref", F.split("text", " ").alias("w"))
    x = c.select("ref", "w", F.posexplode("w").alias("i", "_"))
    return x.select("ref", F.col("i").cast("long").alias("i"), F.array_join(folds.sliding_view(F.col("w"), F.col("i"), 3), " ").alias("visible"))


@query("win22_dated_plan", """WITH o AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS k FROM orders), s AS (SELECT DISTINCT o_custkey, unnest(range(1, 13)) AS k FROM orders)
SELECT s.o_custkey, strftime(DATE '2024-03-01' + (s.k - 1)::INT, '%Y-%m-%d') AS day, ['A', 'B', 'C'][1 + (s.k - 1) % 3] AS variant, o_orderkey FROM s LEFT JOIN o ON o.o_custkey = s.o_custkey AND o.k = s.k""")
def dated_plan(read):
    return folds.dated_plan(read("orders"), "o_custkey", "o_orderkey", "2024-03-01", 12, ["A", "B", "C"])


@query("win23_component_timeline", f"""WITH t AS (SELECT l_suppkey AS k, l_orderkey, l_linenumber, l_partkey, l_quantity::BIGINT AS q, sum(l_quantity::BIGINT) OVER (PARTITION BY l_suppkey ORDER BY {", ".join(LINE_ORDER)} ROWS UNBOUNDED PRECEDING) AS e, sum(l_quantity::BIGINT) OVER (PARTITION BY l_suppkey) AS t FROM lineitem)
SELECT k, l_orderkey, l_linenumber, l_partkey, (e - q)::BIGINT AS starts, e::BIGINT AS ends, abs(t - (t + k % 3 * 0.4)) <= 0.5 AS fits FROM t""")
def component_timeline(read):
    lines = read("lineitem").withColumn("q", F.col("l_quantity").cast("long"))
    at = timeline.running_offset(lines, ["l_suppkey"], [F.col(c) for c in LINE_ORDER], "q", "starts")
    totals = lines.groupBy("l_suppkey").agg(F.sum("q").alias("whole")).withColumn("recorded", F.col("whole") + F.col("l_suppkey") % 3 * 0.4)
    fits = F.abs(F.col("whole") - F.col("recorded")) <= 0.5
    return at.join(totals, "l_suppkey").select(F.col("l_suppkey").alias("k"), "l_orderkey", "l_linenumber", "l_partkey", "starts", (F.col("starts") + F.col("q")).alias("ends"), fits.alias("fits"))


@query("top5_canonical_order", f"WITH {ITEMS} SELECT coll, seq, ref FROM items ORDER BY coll, seq")
def canonical(read):
    return items(read).select("coll", "seq", "ref").orderBy("coll", "seq")


@query("set3_required_subset", "SELECT user_id, count(DISTINCT event_type) FILTER (event_type IN ('view', 'click', 'purchase')) = 3 AS covered FROM events GROUP BY user_id")
def required_subset(read):
    seen = read("events").groupBy("user_id").agg(F.collect_set("event_type").alias("seen"))  # an enumeration: five types
    need = F.array(F.lit("view"), F.lit("click"), F.lit("purchase"))
    return seen.select("user_id", (F.size(F.array_except(need, F.col("seen"))) == 0).alias("covered"))


@query("set5_replace_scope", "SELECT o_orderkey, o_orderstatus AS status FROM orders WHERE o_orderpriority NOT LIKE '1%' UNION ALL SELECT o_orderkey, 'rechecked' FROM orders WHERE o_orderpriority LIKE '1%' AND o_totalprice > 1000")
def replace_scope(read):
    o = read("orders")
    scope = F.col("o_orderpriority").startswith("1")
    fresh = o.filter(scope & (F.col("o_totalprice") > 1000)).select("o_orderkey", F.lit("rechecked").alias("status"))
    return o.filter(~scope).select("o_orderkey", F.col("o_orderstatus").alias("status")).unionByName(fresh)


@query("con1_response_contract", f"""WITH {ITEMS}, x AS (SELECT coll, ref, CASE WHEN coll % 17 = 0 OR (coll + seq) % 7 = 0 THEN 'missing' WHEN (coll + seq) % 11 = 0 THEN 'duplicate' WHEN (coll + seq) % 13 = 0 OR trim(coalesce(text, '')) = '' THEN 'empty' END AS problem FROM items)
SELECT * FROM x WHERE problem IS NOT NULL UNION ALL SELECT DISTINCT coll, 'x:' || coll, 'unknown' FROM items WHERE coll % 9 = 0 AND coll % 17 <> 0 UNION ALL SELECT DISTINCT coll, NULL, 'unreadable' FROM items WHERE coll % 17 = 0""")
def response_contract(read):
    it, at = items(read), F.col("coll") + F.col("seq")
    times = F.when(at % 7 == 0, 0).when(at % 11 == 0, 2).otherwise(1)
    text = F.when((at % 13 == 0) & (at % 11 != 0), F.lit(" ")).otherwise(F.col("text"))
    entry = F.array_repeat(F.struct("ref", text.alias("text")), times)
    stray = F.array_repeat(F.struct(F.concat(F.lit("x:"), "coll").alias("ref"), F.lit("u").alias("text")), F.when(F.col("coll") % 9 == 0, 1).otherwise(0))
    made = it.groupBy("coll").agg(F.flatten(F.collect_list(entry)).alias("rows"))
    body = F.when(F.col("coll") % 17 == 0, "no answer").otherwise(F.concat(F.lit("```json\n"), F.to_json(F.concat("rows", stray)), F.lit("\n```")))
    return C.response_issues(made.select("coll", body.alias("body")), it.select("coll", "ref"), "coll")


