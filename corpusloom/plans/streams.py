"""Streaming queries over the events table."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.plans.base import ORACLES, QUERIES
from corpusloom.streaming import intake
from corpusloom.streaming.runner import drain


def _stream(name: str, oracle: str):
    def register(job):
        QUERIES[name] = lambda spark, sf_dir: drain(spark, f"{sf_dir}/events.parquet", job)
        ORACLES[name] = oracle
        return job

    return register


@_stream("str1_observation_intake", "SELECT event_id, CASE WHEN n = 1 THEN 'stored' WHEN p = f THEN 'noop' ELSE 'conflict' END AS outcome FROM (SELECT event_id, event_id % 2 AS p, row_number() OVER w AS n, first_value(event_id % 2) OVER w AS f FROM events WINDOW w AS (PARTITION BY user_id, event_type ORDER BY event_id))")
def observation_intake(events):
    return intake.intake(events.withColumn("payload", F.col("event_id") % 2), ["user_id", "event_type"], "event_id", "payload")


@_stream("str2_reservation_ledger", """WITH RECURSIVE r AS MATERIALIZED (SELECT user_id, event_id, event_id % 97 AS a, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events),
f AS (SELECT user_id, n, event_id, a <= 1500 AS accepted, (CASE WHEN a <= 1500 THEN a ELSE 0 END)::BIGINT AS held FROM r WHERE n = 1
UNION ALL SELECT r.user_id, r.n, r.event_id, held + a <= 1500, CASE WHEN held + a <= 1500 THEN held + a ELSE held END FROM f JOIN r ON r.user_id = f.user_id AND r.n = f.n + 1) SELECT event_id, accepted, held FROM f""")
def reservation_ledger(events):
    out = intake.ledger(events.withColumn("amount", F.col("event_id") % 97), "user_id", "event_id", "amount", 1500)
    return out.withColumn("held", F.col("held").cast("long"))


@_stream("str3_compare_and_set", """WITH RECURSIVE r AS MATERIALIZED (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n, CASE WHEN event_id % 3 = 0 THEN 1 WHEN event_id % 3 = 1 THEN -1 ELSE event_id % 2 END AS e, event_id % 2 AS p FROM events),
f AS (SELECT user_id, n, event_id, e = -1 AS ok, (CASE WHEN e = -1 THEN p ELSE -1 END)::BIGINT AS v FROM r WHERE n = 1
UNION ALL SELECT r.user_id, r.n, r.event_id, e = v, CASE WHEN e = v THEN p ELSE v END FROM f JOIN r ON r.user_id = f.user_id AND r.n = f.n + 1) SELECT event_id, CASE WHEN ok THEN 'updated' ELSE 'stale' END AS status FROM f""")
def compare_and_set(events):
    want = F.when(F.col("event_id") % 3 == 0, 1).when(F.col("event_id") % 3 == 1, -1).otherwise(F.col("event_id") % 2).cast("long")
    return intake.compare_and_set(events.withColumns({"want": want, "payload": F.col("event_id") % 2}), "user_id", "event_id", "want", "payload")


@_stream("str2_settled_ledger", """WITH RECURSIVE r AS MATERIALIZED (SELECT user_id, event_id, CASE event_id % 5 WHEN 3 THEN 'settle' WHEN 4 THEN 'release' ELSE 'reserve' END AS w, CASE WHEN event_id % 31 = 0 THEN NULL WHEN event_id % 29 = 0 THEN -1 ELSE (event_id % 97)::DECIMAL(18,2) / 4 END::DECIMAL(18,2) AS a, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events),
f AS (SELECT user_id, 0::BIGINT AS n, NULL::BIGINT AS event_id, NULL::VARCHAR AS status, 0::DECIMAL(18,2) AS spent, 0::DECIMAL(18,2) AS held FROM (SELECT DISTINCT user_id FROM events)
UNION ALL SELECT user_id, n, event_id, s, CASE WHEN s = 'accepted' AND w = 'settle' THEN spent + a ELSE spent END, CASE WHEN s <> 'accepted' THEN held WHEN w = 'reserve' THEN held + a ELSE held - a END FROM (SELECT r.user_id, r.n, r.event_id, w, a, spent, held, CASE WHEN a IS NULL OR a < 0 THEN 'invalid' WHEN w = 'reserve' THEN CASE WHEN spent + held + a <= 225.5 THEN 'accepted' ELSE 'over_ceiling' END WHEN a > held THEN 'not_held' ELSE 'accepted' END AS s FROM f JOIN r ON r.user_id = f.user_id AND r.n = f.n + 1))
SELECT event_id, status, spent::DOUBLE AS spent, held::DOUBLE AS held FROM f WHERE n > 0""")
def settled(events):
    k = F.col("event_id")
    action = F.when(k % 5 == 3, "settle").when(k % 5 == 4, "release").otherwise("reserve")
    amount = F.when(k % 31 == 0, None).when(k % 29 == 0, -1.0).otherwise((k % 97) / 4)
    out = intake.settled_ledger(events.withColumns({"action": action, "amount": amount}), "user_id", "event_id", "action", "amount", "225.5")
    return out.withColumns({"spent": F.col("spent").cast("double"), "held": F.col("held").cast("double")})


@_stream("str3_snapshot_history", """WITH RECURSIVE r AS MATERIALIZED (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n, md5('p' || event_id % 3) AS c, CASE WHEN event_id % 4 = 0 THEN NULL ELSE md5('p' || event_id % 2) END AS e FROM events),
f AS (SELECT user_id, 0::BIGINT AS n, NULL::BIGINT AS event_id, NULL::VARCHAR AS status, NULL::VARCHAR AS previous, NULL::VARCHAR AS current FROM (SELECT DISTINCT user_id FROM events)
UNION ALL SELECT r.user_id, r.n, r.event_id, CASE WHEN e IS DISTINCT FROM current THEN 'stale' WHEN c IS NOT DISTINCT FROM current THEN 'unchanged' ELSE 'updated' END, current, CASE WHEN e IS DISTINCT FROM current THEN current ELSE c END FROM f JOIN r ON r.user_id = f.user_id AND r.n = f.n + 1)
SELECT event_id, status, previous, current FROM f WHERE n > 0""")
def history(events):
    k = F.col("event_id")
    expected = F.when(k % 4 != 0, F.md5(F.concat(F.lit("p"), (k % 2).cast("string"))))
    return intake.snapshot_history(events.withColumns({"want": expected, "content": F.md5(F.concat(F.lit("p"), (k % 3).cast("string")))}), "user_id", "event_id", "want", "content")
