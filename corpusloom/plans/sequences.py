"""Queries on ordered folds, windows and timelines."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from corpusloom.operators import folds, timeline
from corpusloom.plans.base import ITEMS, LINE_ORDER, items, query

ORDER_SQL = ", ".join(LINE_ORDER)
LINES = f"SELECT l_suppkey AS k, row_number() OVER (PARTITION BY l_suppkey ORDER BY {ORDER_SQL}) AS n, l_quantity::BIGINT AS c FROM lineitem"


def fold_sql(rows: str, new: str, seed_tot: str = "c", closed: str = "false") -> str:
    """A recursive query that folds rows (k, n, c) into units; ``new`` decides on f (unit, cnt, tot, done) and r (c)."""
    return f"""WITH RECURSIVE r AS MATERIALIZED ({rows}), f AS (
 SELECT k, n, c, 0::BIGINT AS unit, 1::BIGINT AS cnt, {seed_tot} AS tot, ({closed.replace('@tot', '0').replace('@unit', '0').replace('@c', 'c')}) AS done FROM r WHERE n = 1
 UNION ALL SELECT k, n, c, unit, cnt, tot, ({closed.replace('@tot', '(tot - c)').replace('@unit', 'unit').replace('@c', 'c')}) FROM (
  SELECT r.k, r.n, r.c, CASE WHEN done OR {new} THEN unit + 1 ELSE unit END AS unit, CASE WHEN done OR {new} THEN 1 ELSE cnt + 1 END AS cnt, CASE WHEN done OR {new} THEN r.c ELSE tot + r.c END AS tot FROM f JOIN r ON r.k = f.k AND r.n = f.n + 1))
SELECT k, unit, count(*) AS n_items, sum(c)::BIGINT AS total FROM f GROUP BY k, unit"""


def _lines(read):
    return read("lineitem").withColumn("c", F.col("l_quantity").cast("long"))


def _packed(read, rule):
    rows = folds.fold_units(_lines(read).select("l_suppkey", "c", *LINE_ORDER), ["l_suppkey"], [F.col(c) for c in LINE_ORDER], "c", rule)
    return folds.unit_table(rows, ["l_suppkey"], "c").withColumnRenamed("l_suppkey", "k")


@query("win1_greedy_packing", fold_sql(LINES, "(cnt >= 32 OR tot + r.c > 650)"))
def greedy(read):
    return _packed(read, folds.greedy(32, 650))


@query("win2_packing_with_separators", fold_sql(LINES, "(cnt >= 1000000 OR tot + r.c + 2 * cnt > 500)"))
def separators(read):
    return _packed(read, folds.greedy(1_000_000, 500, 2))


@query("win3_packing_with_sections", fold_sql(LINES.replace("l_suppkey AS k", "l_suppkey * 100 + l_partkey % 7 AS k").replace("PARTITION BY l_suppkey", "PARTITION BY l_suppkey, l_partkey % 7"), "(cnt >= 20 OR tot + r.c > 400)"))
def sections(read):
    rows = _lines(read).withColumn("section", F.col("l_partkey") % 7).select("l_suppkey", "section", "c", *LINE_ORDER)
    packed = folds.fold_units(rows, ["l_suppkey", "section"], [F.col(c) for c in LINE_ORDER], "c", folds.greedy(20, 400))
    keyed = packed.withColumn("k", F.col("l_suppkey") * 100 + F.col("section"))
    return folds.unit_table(keyed, ["k"], "c")


@query("win6_nearest_to_target", fold_sql(LINES, "(tot + r.c >= 300 AND 300 - tot <= tot + r.c - 300)", closed="@tot + @c >= 300"))
def nearest(read):
    return _packed(read, folds.nearest_to(300))


@query("win8_canary_then_shards", fold_sql(LINES, "(tot + r.c > 700)", closed="@unit = 0"))
def canary(read):
    return _packed(read, folds.canary(700))


@query("win4_reader_paragraphs", fold_sql("SELECT conv_id AS k, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n, length(text)::BIGINT + 1 AS c FROM conversations", "(cnt >= 1000000 OR tot + r.c > 900)"))
def paragraphs(read):
    rows = items(read).select("coll", "seq", (F.length("text") + 1).cast("long").alias("c"))
    packed = folds.fold_units(rows, ["coll"], [F.col("seq")], "c", folds.greedy(1_000_000, 900))
    return folds.unit_table(packed, ["coll"], "c").withColumnRenamed("coll", "k")


@query("win10_short_span_groups", fold_sql("SELECT conv_id AS k, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n, length(text)::BIGINT AS c FROM conversations", "(r.c > 300 OR cnt >= 4 OR tot > 300 AND cnt = 1 OR tot + r.c > 900)"))
def span_groups(read):
    rows = items(read).select("coll", "seq", F.length("text").cast("long").alias("c"))
    packed = folds.fold_units(rows, ["coll"], [F.col("seq")], "c", folds.alone_if(300, 4, 900))
    return folds.unit_table(packed, ["coll"], "c").withColumnRenamed("coll", "k")


@query("win7_fixed_shards", "SELECT o_custkey, o_orderkey, ((row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) // 4)::BIGINT AS shard FROM orders")
def fixed_shards(read):
    w = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    return read("orders").select("o_custkey", "o_orderkey", F.floor((F.row_number().over(w) - 1) / 4).alias("shard"))


@query("win5_balanced_split", f"""WITH RECURSIVE r AS MATERIALIZED (SELECT k, n, c, sum(c) OVER (PARTITION BY k)::BIGINT AS t, count(*) OVER (PARTITION BY k) AS m, sum(c) OVER (PARTITION BY k ORDER BY n)::BIGINT AS cum FROM ({LINES})),
f AS (SELECT k, n, c, 0::BIGINT AS unit, (cum * 5 >= t * 1 AND m - 1 >= 4) AS done FROM r WHERE n = 1
 UNION ALL SELECT r.k, r.n, r.c, unit + done::INT, unit + done::INT < 4 AND r.cum * 5 >= r.t * (unit + done::INT + 1) AND r.m - r.n >= 5 - (unit + done::INT) - 1 FROM f JOIN r ON r.k = f.k AND r.n = f.n + 1)
SELECT k, unit, count(*) AS n_items, sum(c)::BIGINT AS total FROM f GROUP BY k, unit""")
def balanced(read):
    split = folds.balanced_split(_lines(read).select("l_suppkey", "c", *LINE_ORDER), "l_suppkey", LINE_ORDER, "c", 5)
    return split.groupBy(F.col("l_suppkey").alias("k"), "unit").agg(F.count(F.lit(1)).alias("n_items"), F.sum("c").alias("total"))


@query("win13_event_end", "SELECT event_id, greatest(e, coalesce(lead(s) OVER (PARTITION BY user_id ORDER BY s, event_id), 9999999999)) AS event_end FROM (SELECT event_id, user_id, floor(epoch(ts))::BIGINT AS s, floor(epoch(ts))::BIGINT + event_id % 50 AS e FROM events)")
def event_end(read):
    ev = read("events").select("event_id", "user_id", F.unix_timestamp("ts").alias("s")).withColumn("e", F.col("s") + F.col("event_id") % 50)
    return timeline.event_end(ev, ["user_id"], [F.col("s"), F.col("event_id")], "s", "e", F.lit(9999999999)).select("event_id", "event_end")


@query("win14_running_offset", f"SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, l_quantity::BIGINT AS q, (sum(l_quantity::BIGINT) OVER (PARTITION BY l_suppkey ORDER BY {ORDER_SQL} ROWS UNBOUNDED PRECEDING) - l_quantity::BIGINT)::BIGINT AS offset_q FROM lineitem")
def running_offset(read):
    out = timeline.running_offset(_lines(read), ["l_suppkey"], [F.col(c) for c in LINE_ORDER], "c", "offset_q")
    return out.select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", F.col("c").alias("q"), "offset_q")


@query("win16_bounded_interpolation", """WITH e AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p, CASE WHEN event_id % 5 NOT IN (1, 2) THEN event_id::DOUBLE END AS v FROM events),
x AS (SELECT *, max(CASE WHEN v IS NOT NULL THEN p END) OVER (PARTITION BY user_id ORDER BY p) AS lp, min(CASE WHEN v IS NOT NULL THEN p END) OVER (PARTITION BY user_id ORDER BY p ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rp FROM e),
y AS (SELECT x.*, a.v AS lv, b.v AS rv FROM x LEFT JOIN e a ON a.user_id = x.user_id AND a.p = x.lp LEFT JOIN e b ON b.user_id = x.user_id AND b.p = x.rp)
SELECT event_id, round(CASE WHEN v IS NOT NULL THEN v WHEN rp - lp - 1 <= 2 THEN lv + (rv - lv) * ((p - lp) / (rp - lp)) END, 6) AS filled, CASE WHEN v IS NOT NULL THEN 'known' WHEN rp - lp - 1 <= 2 THEN 'interpolated' ELSE 'unknown' END AS source FROM y""")
def interpolation(read):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    ev = read("events").select("user_id", "event_id", F.row_number().over(w).alias("p"), F.when(~(F.col("event_id") % 5).isin(1, 2), F.col("event_id").cast("double")).alias("v"))
    return timeline.interpolate(ev, ["user_id"], "p", "v", 2).select("event_id", F.round("filled", 6).alias("filled"), "source")


@query("win17_order_breaks", "SELECT event_id, CASE WHEN e <= s THEN 'empty' ELSE 'overlap' END AS problem FROM (SELECT event_id, floor(epoch(ts))::BIGINT AS s, floor(epoch(ts))::BIGINT + event_id % 3 * 40000 AS e, lag(floor(epoch(ts))::BIGINT + event_id % 3 * 40000) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events) WHERE e <= s OR s < p")
def order_breaks(read):
    ev = read("events").select("event_id", "user_id", "ts", F.unix_timestamp("ts").alias("s")).withColumn("e", F.col("s") + F.col("event_id") % 3 * 40000)
    return timeline.order_breaks(ev, ["user_id"], [F.col("ts"), F.col("event_id")], "s", "e").select("event_id", "problem")


@query("win20_stable_codes", "SELECT s_suppkey, row_number() OVER (ORDER BY sha256('salt' || s_suppkey)) AS code FROM supplier")
def stable_codes(read):
    from corpusloom.functions.ordinals import global_ordinal

    coded = read("supplier").select("s_suppkey", F.sha2(F.concat(F.lit("salt"), "s_suppkey").cast("binary"), 256).alias("h"))
    return global_ordinal(coded, ["h"], "code").select("s_suppkey", "code")


@query("win19_latest_per_customer", "SELECT o_custkey, max(o_orderkey) FILTER (o_orderdate = m) AS o_orderkey FROM (SELECT *, max(o_orderdate) OVER (PARTITION BY o_custkey) AS m FROM orders) GROUP BY o_custkey")
def latest(read):
    return read("orders").groupBy("o_custkey").agg(F.max(F.struct("o_orderdate", "o_orderkey")).alias("m")).select("o_custkey", "m.o_orderkey")


@query("win24_proportional_split", f"""WITH {ITEMS}, w AS (SELECT coll, seq, sum(greatest(length(text), 1)) OVER (PARTITION BY coll ORDER BY seq) AS a, greatest(length(text), 1) AS x, sum(greatest(length(text), 1)) OVER (PARTITION BY coll) AS t FROM items)
SELECT coll, seq, round(10.0 + 60.0::DOUBLE * (a - x) / t, 6) AS piece_start, round(10.0 + 60.0::DOUBLE * a / t, 6) AS piece_end FROM w""")
def proportional(read):
    it = items(read).withColumns({"start": F.lit(10.0), "span": F.lit(60.0)})
    return timeline.proportional_split(it, ["coll"], [F.col("seq")], F.length("text"), "start", "span").select("coll", "seq", "piece_start", "piece_end")


@query("snk4_caption_rows", """WITH e AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS cue, event_id % 7200000 AS ms, event_type FROM events)
SELECT user_id, cue, printf('%d%s%02d:%02d:%02d,%03d --> %02d:%02d:%02d,%03d%s%s', cue, chr(10), ms // 3600000, ms // 60000 % 60, ms // 1000 % 60, ms % 1000, (ms + 1500) // 3600000, (ms + 1500) // 60000 % 60, (ms + 1500) // 1000 % 60, (ms + 1500) % 1000, chr(10), event_type) AS block FROM e""")
def captions(read):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    at = (F.col("event_id") % 7200000) / 1000
    ev = read("events").select("user_id", F.row_number().over(w).cast("long").alias("cue"), at.alias("s"), "event_type")
    block = F.concat(F.col("cue"), F.lit("\n"), timeline.clock(F.col("s")), F.lit(" --> "), timeline.clock(F.col("s") + 1.5), F.lit("\n"), "event_type")
    return ev.select("user_id", "cue", block.alias("block"))


@query("top1_ranked_catalog", "SELECT p_partkey, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 50")
def ranked(read):
    return read("part").orderBy(F.desc("p_retailprice"), "p_partkey").limit(50).select("p_partkey", "p_retailprice")


@query("top3_pending_queue", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus IN ('P', 'F') ORDER BY CASE o_orderstatus WHEN 'P' THEN 0 ELSE 1 END, o_orderkey LIMIT 100")
def pending(read):
    o = read("orders").filter(F.col("o_orderstatus").isin("P", "F"))
    return o.orderBy(F.when(F.col("o_orderstatus") == "P", 0).otherwise(1), "o_orderkey").limit(100).select("o_orderkey", "o_orderstatus")


@query("top4_shortest_exemplars", "SELECT source, doc_id FROM documents QUALIFY row_number() OVER (PARTITION BY source ORDER BY length(text), doc_id) <= 3")
def exemplars(read):
    w = Window.partitionBy("source").orderBy(F.length("text"), "doc_id")
    return read("documents").withColumn("k", F.row_number().over(w)).filter("k <= 3").select("source", "doc_id")
