"""Queries on statuses, metrics, cohorts, costs, schedules and gates over recorded values."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.operators import evals as E
from corpusloom.operators import gates as G
from corpusloom.operators import rules as R
from corpusloom.plans.base import query


@query("agg1_status_totals", "SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY o_orderstatus")
def status_totals(read):
    return read("orders").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("agg2_run_status", "SELECT o_custkey, CASE WHEN bool_and(o_orderstatus = 'F') THEN 'complete' WHEN bool_or(o_orderstatus = 'P') THEN 'has_failures' ELSE 'in_progress' END AS status FROM orders GROUP BY o_custkey")
def run_status(read):
    s = F.col("o_orderstatus")
    return read("orders").groupBy("o_custkey").agg(F.when(F.bool_and(s == "F"), "complete").when(F.bool_or(s == "P"), "has_failures").otherwise("in_progress").alias("status"))


@query("agg3_stage_matrix", "SELECT user_id, " + ", ".join(f"count(*) FILTER (event_type = '{t}') AS {t}_n" for t in ("view", "click", "error", "signup", "purchase")) + " FROM events GROUP BY user_id")
def stage_matrix(read):
    types = ("view", "click", "error", "signup", "purchase")
    return read("events").groupBy("user_id").agg(*[F.count_if(F.col("event_type") == t).alias(f"{t}_n") for t in types])


@query("agg8_usage_by_model", "SELECT event_type AS model, key, sum(v)::BIGINT AS total FROM (SELECT event_type, unnest(json_keys(props)) AS key, props FROM events), LATERAL (SELECT (props->>key)::BIGINT AS v) GROUP BY ALL")
def usage_by_model(read):
    usage = F.from_json("props", "map<string,long>")
    return read("events").select(F.col("event_type").alias("model"), F.explode(usage).alias("key", "v")).groupBy("model", "key").agg(F.sum("v").alias("total"))


@query("agg11_severity_matrix", "SELECT doc_id % 4 AS judge, count(*) FILTER (toxic = 1) AS blocking, count(*) FILTER (quality = 0 AND toxic = 0) AS minor, count(*) FILTER (quality = 1 AND toxic = 0) AS clean FROM labels GROUP BY judge")
def severity_matrix(read):
    sev = F.when(F.col("toxic") == 1, "blocking").when(F.col("quality") == 0, "minor").otherwise("clean")
    wide = read("labels").select((F.col("doc_id") % 4).alias("judge"), sev.alias("s")).groupBy("judge").pivot("s", ["blocking", "minor", "clean"]).count()
    return wide.fillna(0)


@query("agg12_mean_scores", "SELECT label, round(avg(vec_id % 5 + 1), 3) AS mean_score FROM embeddings GROUP BY label")
def mean_scores(read):
    return read("embeddings").groupBy("label").agg(F.round(F.avg(F.col("vec_id") % 5 + 1), 3).alias("mean_score"))


@query("agg13_consensus", """WITH j AS (SELECT doc_id // 3 AS item, doc_id % 3 AS judge, CASE WHEN toxic = 1 THEN 3.0 WHEN quality = 0 THEN 1.0 ELSE 0.25 END AS w FROM labels)
SELECT item, count(DISTINCT judge) = 3 AS consensus, max(w)::DOUBLE AS severity, sum(w)::DOUBLE AS weight FROM j GROUP BY item""")
def consensus(read):
    w = F.when(F.col("toxic") == 1, 3.0).when(F.col("quality") == 0, 1.0).otherwise(0.25)
    j = read("labels").select(F.floor(F.col("doc_id") / 3).alias("item"), (F.col("doc_id") % 3).alias("judge"), w.alias("w"))
    return j.groupBy("item").agg((F.count_distinct("judge") == 3).alias("consensus"), F.max("w").alias("severity"), F.sum("w").alias("weight"))


@query("agg14_detector_scorecard", r"""WITH c AS (SELECT doc_id, toxic, regexp_matches(text, '(?i)\b(idiot|moron|scum|trash)\b') AS hit FROM labels JOIN documents USING (doc_id))
SELECT round(count(*) FILTER (toxic = 1 AND hit) / count(*) FILTER (toxic = 1), 6) AS recall, round(count(*) FILTER (toxic = 0 AND hit) / count(*) FILTER (toxic = 0), 6) AS false_positive_rate, count(*) AS cases FROM c""")
def scorecard(read):
    c = read("labels").join(read("documents"), "doc_id").select("toxic", (R.banned_terms(F.col("text"), ["idiot", "moron", "scum", "trash"]) != "").alias("hit"))
    share = lambda t: F.round(F.count_if((F.col("toxic") == t) & F.col("hit")) / F.count_if(F.col("toxic") == t), 6)
    return c.agg(share(1).alias("recall"), share(0).alias("false_positive_rate"), F.count(F.lit(1)).alias("cases"))


@query("agg15_cohort_summary", "SELECT event_type, dayofweek(ts) + 1 AS weekday, count(v) AS known, count(*) - count(v) AS unknown, round(median(v), 6) AS median, count(v) >= 50 AS enough FROM (SELECT event_type, ts, CASE WHEN event_id % 6 <> 0 THEN value END AS v FROM events) GROUP BY ALL")
def cohorts(read):
    ev = read("events").select("event_type", F.dayofweek("ts").cast("long").alias("weekday"), F.when(F.col("event_id") % 6 != 0, F.col("value")).alias("v"))
    return E.cohort_summary(ev, ["event_type", "weekday"], "v", 50)


@query("agg16_definition_conflicts", "SELECT user_id, count(DISTINCT event_id % 3) AS definitions FROM events WHERE event_type = 'purchase' GROUP BY user_id HAVING count(DISTINCT event_id % 3) > 1")
def definitions(read):
    p = read("events").filter("event_type = 'purchase'")
    return p.groupBy("user_id").agg(F.count_distinct(F.col("event_id") % 3).alias("definitions")).filter("definitions > 1")


@query("agg17_nearest_rank", "WITH r AS (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY value) AS r, count(*) OVER (PARTITION BY event_type) AS n FROM events) SELECT event_type, value AS p FROM r WHERE r = round_even(0.95 * (n - 1), 0) + 1")
def nearest_rank(read):
    return E.nearest_rank(read("events").select("event_type", "value"), ["event_type"], "value", 0.95)


@query("agg18_coverage_ratios", "SELECT user_id, round(avg((event_id % 5 <> 1)::INT), 6) AS exact, round(avg((event_id % 7 <> 1)::INT), 6) AS mapped FROM events GROUP BY user_id")
def coverage(read):
    flag = lambda n: F.round(F.avg((F.col("event_id") % n != 1).cast("int")), 6)
    return read("events").groupBy("user_id").agg(flag(5).alias("exact"), flag(7).alias("mapped"))


PRICES = [("A", 3.0, 0.3, 15.0), ("N", 1.0, 0.1, 5.0)]
PRICE_SQL = "p(model, i, c, o) AS (VALUES ('A', 3.0::DOUBLE, 0.3::DOUBLE, 15.0::DOUBLE), ('N', 1.0, 0.1, 5.0))"
USAGE_SQL = "u AS (SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag AS model, l_quantity * 1000 AS i_t, l_quantity * 100 AS c_t, l_partkey % 500 AS o_t FROM lineitem)"


def _usage(read):
    line = read("lineitem")
    usage = line.select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_returnflag").alias("model"), (F.col("l_quantity") * 1000).alias("input_tokens"), (F.col("l_quantity") * 100).alias("cached_tokens"), (F.col("l_partkey") % 500).alias("output_tokens"))
    prices = line.sparkSession.createDataFrame(PRICES, "model string, input_rate double, cached_rate double, output_rate double")
    return E.usage_cost(usage, prices)


@query("evl3_usage_cost", f"WITH {PRICE_SQL}, {USAGE_SQL} SELECT l_orderkey, l_linenumber, l_partkey, model, round(((i_t - c_t) * i + c_t * c + o_t * o) / 1e6, 8) AS cost FROM u LEFT JOIN p USING (model)")
def cost(read):
    return _usage(read).select("l_orderkey", "l_linenumber", "l_partkey", "model", "cost")


@query("jon15_price_gaps", f"WITH {PRICE_SQL}, {USAGE_SQL} SELECT model, count(*) AS rows FROM u WHERE model NOT IN (SELECT model FROM p) GROUP BY model")
def price_gaps(read):
    return _usage(read).filter("cost is null").groupBy("model").agg(F.count(F.lit(1)).alias("rows"))


@query("agg20_spend_summary", f"WITH {PRICE_SQL}, {USAGE_SQL} SELECT model, round(sum(((i_t - c_t) * i + c_t * c + o_t * o) / 1e6), 4) AS spent, round(10000 - sum(((i_t - c_t) * i + c_t * c + o_t * o) / 1e6), 4) AS remaining FROM u JOIN p USING (model) GROUP BY model")
def spend(read):
    s = _usage(read).filter("cost is not null").groupBy("model").agg(F.sum("cost").alias("s"))
    return s.select("model", F.round("s", 4).alias("spent"), F.round(F.lit(10000) - F.col("s"), 4).alias("remaining"))


@query("agg22_calibrated_estimate", "SELECT lang, round(sum(CASE WHEN doc_id % 10 = 0 THEN length(text) * 0.1 END) / sum(CASE WHEN doc_id % 10 = 0 THEN length(text) END) * sum(length(text)), 3) AS seconds FROM documents GROUP BY lang")
def estimate(read):
    n = F.length("text")
    sample = F.when(F.col("doc_id") % 10 == 0, n)
    return read("documents").groupBy("lang").agg(F.round(F.sum(sample * 0.1) / F.sum(sample) * F.sum(n), 3).alias("seconds"))


@query("evl1_weighted_score", "SELECT p_partkey, CASE WHEN p_size % 6 BETWEEN 1 AND 5 THEN round(((p_partkey % 5 + 1) * 50 + (p_size % 6) * 30 + 3 * 20) / 5.0, 1) END AS score FROM part")
def weighted(read):
    values = {"hook": F.col("p_partkey") % 5 + 1, "clarity": F.col("p_size") % 6, "fit": F.lit(3)}
    return read("part").select("p_partkey", E.weighted_score(values, {"hook": 50, "clarity": 30, "fit": 20}).alias("score"))


@query("evl2_reading_time", r"SELECT doc_id, len(regexp_extract_all(text, '[A-Za-z0-9'']+')) AS words, round(len(regexp_extract_all(text, '[A-Za-z0-9'']+')) * 60.0 / 150, 1) AS seconds FROM documents")
def reading(read):
    w = E.word_count(F.col("text"))
    return read("documents").select("doc_id", w.alias("words"), E.reading_seconds(w, 150).alias("seconds"))


@query("evl4_request_ceiling", "SELECT doc_id, round((greatest(1, strlen(text) // 2) * 3.75::DOUBLE + 4096 * 15.0::DOUBLE) / 1e6, 8) AS ceiling FROM documents")
def ceiling(read):
    return read("documents").select("doc_id", E.request_ceiling(F.col("text"), 4096, 3.75, 15.0).alias("ceiling"))


NOW = "2024-02-01 00:00:00"


@query("evl5_measurement_schedule", f"""SELECT event_id, w AS window_hours, CASE WHEN h > w + t THEN 'missed' WHEN h >= w - t THEN 'due' ELSE 'upcoming' END AS state FROM (SELECT event_id, date_diff('second', ts, TIMESTAMP '{NOW}') / 3600.0 AS h FROM events), (VALUES (24, 6), (72, 12), (168, 24)) v(w, t)""")
def schedule(read):
    windows = read("events").sparkSession.createDataFrame([(24, 6), (72, 12), (168, 24)], "window_hours int, t int")
    h = F.timestamp_diff("SECOND", F.date_trunc("second", F.col("ts")), F.lit(NOW).cast("timestamp")) / 3600.0  # whole seconds of the clock, not of the time between
    rows = read("events").select("event_id", h.alias("h")).crossJoin(F.broadcast(windows))  # three fixed windows
    state = F.when(F.col("h") > F.col("window_hours") + F.col("t"), "missed").when(F.col("h") >= F.col("window_hours") - F.col("t"), "due").otherwise("upcoming")
    return rows.select("event_id", "window_hours", state.alias("state"))


@query("prj15_duration_band", "SELECT event_id, CASE WHEN event_id % 60 <= 15 THEN 'short' WHEN event_id % 60 <= 30 THEN 'medium' ELSE 'long' END AS band FROM events")
def bands(read):
    return read("events").select("event_id", R.band(F.col("event_id") % 60, [(15, "short"), (30, "medium")], "long").alias("band"))


#: Ages in hours with their tolerance.
WINDOWS = [(24, 6), (72, 12), (168, 24)]
AGES = "a AS (SELECT event_id, user_id, value, date_diff('second', TIMESTAMP '2024-01-01', ts) / 3600.0 AS h FROM events)"


def _ages(read):
    h = F.timestamp_diff("SECOND", F.lit("2024-01-01 00:00:00").cast("timestamp"), F.col("ts")) / 3600.0
    return read("events").withColumn("h", h)


@query("prj16_age_window", f"WITH {AGES} SELECT event_id, CASE WHEN abs(h - 24) <= 6 THEN 24 WHEN abs(h - 72) <= 12 THEN 72 WHEN abs(h - 168) <= 24 THEN 168 END::BIGINT AS age_window FROM a")
def age_windows(read):
    return _ages(read).select("event_id", R.age_window(F.col("h"), WINDOWS).alias("age_window"))


@query("prj17_per_mille", "SELECT event_id, round((event_id % 17) / nullif(event_id % 9, 0) * 1000, 3) AS rate FROM events")
def per_mille(read):
    return read("events").select("event_id", R.per_mille((F.col("event_id") % 17).cast("double"), (F.col("event_id") % 9).cast("double")).alias("rate"))


@query("win18_best_snapshot", f"WITH {AGES} SELECT user_id, event_id FROM a QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY abs(h - 72), event_id) = 1")
def snapshot(read):
    return E.best_snapshot(_ages(read), ["user_id"], F.col("h"), 72, ["event_id"]).select("user_id", "event_id")


@query("jon12_two_timelines", "SELECT coalesce(a.event_id, b.event_id) AS event_id, CASE WHEN a.event_id IS NULL THEN 'only_right' WHEN b.event_id IS NULL THEN 'only_left' ELSE 'both' END AS side, round(abs(a.value - b.value), 6) AS delta FROM (SELECT * FROM events WHERE event_id % 10 <> 0) a FULL JOIN (SELECT event_id, value * 1.01 AS value FROM events WHERE event_id % 11 <> 0) b ON a.event_id = b.event_id")
def two_timelines(read):
    ev = read("events")
    a = ev.filter("event_id % 10 <> 0").select("event_id", F.col("value").alias("va"))
    b = ev.filter("event_id % 11 <> 0").select("event_id", (F.col("value") * 1.01).alias("vb"))
    side = F.when(F.col("va").isNull(), "only_right").when(F.col("vb").isNull(), "only_left").otherwise("both")
    return a.join(b, "event_id", "full").select("event_id", side.alias("side"), F.round(F.abs(F.col("va") - F.col("vb")), 6).alias("delta"))


@query("top2_largest_disagreements", "SELECT event_id, round(value * 0.01 * (event_id % 7), 6) AS delta FROM events ORDER BY delta DESC, event_id LIMIT 20")
def disagreements(read):
    return read("events").select("event_id", F.round(F.col("value") * 0.01 * (F.col("event_id") % 7), 6).alias("delta")).orderBy(F.desc("delta"), "event_id").limit(20)


@query("res13_retry_set", "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P' AND o_orderkey % 3 <> 0")
def retry(read):
    o = read("orders")
    complete = o.filter("o_orderkey % 3 = 0").select("o_orderkey")
    return o.filter("o_orderstatus = 'P'").join(complete, "o_orderkey", "left_anti").select("o_orderkey")


@query("res16_exhausted_set", "SELECT o_custkey FROM orders WHERE o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F') GROUP BY o_custkey HAVING count(*) >= 3")
def exhausted(read):
    o = read("orders")
    spent = o.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n")).filter("n >= 3")
    return spent.join(o.filter("o_orderstatus = 'F'").select("o_custkey"), "o_custkey", "left_anti").select("o_custkey")


@query("gat16_observation_contract", """SELECT event_id, problem FROM (SELECT event_id, unnest([CASE WHEN value < 1 THEN 'too_small' END, CASE WHEN event_type NOT IN ('view', 'click', 'purchase', 'signup') THEN 'unknown_type' END, CASE WHEN NOT regexp_matches(props, '"k"') THEN 'missing_k' END]) AS problem FROM events) WHERE problem IS NOT NULL""")
def observation_contract(read):
    checks = F.array(
        F.when(F.col("value") < 1, "too_small"),
        F.when(~F.col("event_type").isin("view", "click", "purchase", "signup"), "unknown_type"),
        F.when(~F.coalesce(F.array_contains(F.json_object_keys("props"), "k"), F.lit(False)), "missing_k"),
    )
    return read("events").select("event_id", F.explode(F.array_compact(checks)).alias("problem"))


@query("gat18_plausibility", "SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice / nullif(l_quantity, 0) / 10000 AS ratio, coalesce(l_extendedprice / nullif(l_quantity, 0) BETWEEN 400 AND 1500, false) AS plausible FROM lineitem")
def plausibility(read):
    ratio, plausible = G.plausible_rate(F.col("l_extendedprice"), F.col("l_quantity"), 400, 1500)
    return read("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", (ratio / 10000).alias("ratio"), plausible.alias("plausible"))


@query("evl6_buffer_inventory", "SELECT source, count(*) FILTER (n_chars BETWEEN 200 AND 5000) AS ready, count(*) FILTER (n_chars NOT BETWEEN 200 AND 5000) AS blocked, greatest(0, 40 - count(*) FILTER (n_chars BETWEEN 200 AND 5000)) AS shortfall FROM documents GROUP BY source")
def inventory(read):
    return G.buffer_inventory(read("documents"), ["source"], F.col("n_chars").between(200, 5000), 40)


@query("snk6_review_queue", "SELECT queue, count(*) AS n FROM (SELECT CASE WHEN toxic = 1 THEN 'safety' ELSE 'editing' END AS queue FROM labels WHERE toxic = 1 OR quality = 0) GROUP BY queue")
def review_queue(read):
    q = F.when(F.col("toxic") == 1, "safety").otherwise("editing")
    return read("labels").filter("toxic = 1 or quality = 0").groupBy(q.alias("queue")).agg(F.count(F.lit(1)).alias("n"))


@query("win21_even_sample", "WITH r AS (SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1 AS i, count(*) OVER (PARTITION BY event_type) AS n FROM events), s AS (SELECT DISTINCT event_type, round_even(k * (n - 1) / 9.0, 0)::BIGINT AS i FROM r, range(0, 10) t(k)) SELECT event_type, event_id FROM r JOIN s USING (event_type, i)")
def even_sample(read):
    return E.even_sample(read("events").select("event_type", "event_id"), ["event_type"], ["event_id"], 10)
