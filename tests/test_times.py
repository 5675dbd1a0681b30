"""Queries on times against their SQL, on rows at the edges of seconds and parts."""

from datetime import datetime, timedelta

import duckdb
import pytest
from pyspark.sql import functions as F
from test_queries import rows

from corpusloom import plans
from corpusloom.plans import metrics


def same_as_sql(spark, folder, name, table, df):
    """The query's rows on ``df`` as its table, which must be those of its SQL."""
    df.coalesce(1).write.parquet(f"{folder}/{table}.parquet")
    con = duckdb.connect()
    con.sql("set timezone='UTC'")
    con.sql(f"create view {table} as from '{folder}/{table}.parquet/*.parquet'")
    got, want = plans.QUERIES[name](spark, str(folder)), con.sql(plans.ORACLES[name])
    found = got.collect()
    assert sorted(got.columns) == sorted(want.columns) and rows(got.columns, map(tuple, found)) == rows(want.columns, want.fetchall())
    return found


def events(spark, times, users):
    """One event a time, null included."""
    data = [(i, t, i % users, "view", float(i), "{}") for i, t in enumerate(times)]
    ev = spark.createDataFrame(data, "event_id long, t string, user_id long, event_type string, value double, props string")
    return ev.select("event_id", F.col("t").cast("timestamp_ntz").alias("ts"), "user_id", "event_type", "value", "props")


@pytest.fixture(params=["UTC", "America/New_York"])
def zone(spark, request):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield
    spark.conf.set("spark.sql.session.timeZone", before)


def test_a_part_of_captions_begins_half_a_second_before_its_time(spark, tmp_path, zone):
    edge = ["2024-01-02 23:59:59.499999", "2024-01-02 23:59:59.5", "2024-01-02 23:59:59.500001", "2024-01-02 23:59:59.999999", "2024-01-03 00:00:00", "2024-01-03 00:00:00.5"]
    early = ["1970-01-01 00:00:00", "1969-12-31 23:59:59.4", "1969-12-26 23:59:59.5", "1969-12-26 00:00:00.25", "1969-12-20 12:00:00"]
    assert len(same_as_sql(spark, tmp_path, "snk4_catalog_captions", "events", events(spark, [None, *edge, *edge, None, *early, *edge], 2))) == 23


def test_a_measurement_is_due_by_whole_seconds_of_the_clock(spark, tmp_path, zone):
    hours = [h + x for h, t in ((24, 6), (72, 12), (168, 24)) for x in (-t, t)] + [0, 30 * 24, 60 * 366 * 24]
    now = datetime.fromisoformat(metrics.NOW)
    near = [timedelta(seconds=s, microseconds=m) for s in (-1, 0, 1) for m in (0, 1, 500000, 999999)]
    times = [str(now - timedelta(hours=h) + x) for h in hours for x in near] + [None, "2024-02-01 00:00:00.5", "2024-02-09 12:00:00.75"]
    got = same_as_sql(spark, tmp_path, "evl5_measurement_schedule", "events", events(spark, times, 3))
    assert len(got) == 3 * len(times) and {r["state"] for r in got} == {"missed", "due", "upcoming"}
