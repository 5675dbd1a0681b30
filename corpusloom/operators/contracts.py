"""Contracts on structured responses, attempts and manifests: every violation is a row, nothing stops at the first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.resolve import folded

FENCE = r"(?s)^\s*```(?:json)?\s*|\s*```\s*$"


def first_failure(checks: list[tuple[str, Column]], passed: str = "pass") -> Column:
    """The name of the first check that does not hold (false or null), or ``passed``."""
    return F.coalesce(*[F.when(~F.coalesce(ok, F.lit(False)), name) for name, ok in checks], F.lit(passed))


def failures(df: DataFrame, keys: list[str], checks: list[tuple[str, Column]], name: str = "problem") -> DataFrame:
    """One row per check that does not hold (false or null)."""
    hits = F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), name_) for name_, ok in checks]))
    return df.select(*keys, F.explode(hits).alias(name))


def response_issues(responses: DataFrame, expected: DataFrame, key: str) -> DataFrame:
    """(key, ref, problem) of JSON responses (key, body), maybe code-fenced, against the expected references (key, ref).

    Problems: 'unreadable' (ref null; its references are missing too),
    'missing', 'unknown', 'duplicate', 'empty'.
    """
    body = F.regexp_replace("body", FENCE, "")
    parsed = responses.select(key, F.from_json(body, "array<struct<ref:string,text:string>>").alias("rows"))
    unreadable = parsed.filter("rows is null").select(key, F.lit(None).cast("string").alias("ref"), F.lit("unreadable").alias("problem"))
    entries = parsed.select(key, F.explode("rows").alias("e")).select(key, "e.ref", F.length(F.trim("e.text")).alias("_len"))
    given = entries.groupBy(key, "ref").agg(F.count(F.lit(1)).alias("_n"), F.min(F.coalesce("_len", F.lit(0))).alias("_len"))
    both = expected.select(key, "ref", F.lit(True).alias("_e")).join(given, [key, "ref"], "full")
    problem = F.when(F.col("_n").isNull(), "missing").when(F.col("_e").isNull(), "unknown").when(F.col("_n") > 1, "duplicate").when(F.col("_len") == 0, "empty")
    return both.withColumn("problem", problem).filter("problem is not null").select(key, "ref", "problem").unionByName(unreadable)


def grounded(text: Column, quote: Column) -> Column:
    """Whether a quote stands in a text, case and runs of white space aside; an empty quote does not."""
    return (F.length(F.trim(quote)) > 0) & F.contains(folded(text), folded(quote))


def first_passing(attempts: DataFrame, keys: list[str], attempt: str, passed: str, value: str) -> DataFrame:
    """Per key the first attempt that passes and its value; null where none does."""
    ok = F.when(F.col(passed), F.struct(F.col(attempt), F.col(value)))
    best = attempts.groupBy(*keys).agg(F.min(ok).alias("_b"))
    return best.select(*keys, F.col(f"_b.{attempt}").alias(attempt), F.col(f"_b.{value}").alias(value))


def roll_up(parts: DataFrame, keys: list[str], status: str) -> DataFrame:
    """'failed' if any part failed, 'pending' if any is incomplete, else 'joinable'."""
    s = F.col(status)
    out = F.when(F.bool_or(s == "failed"), "failed").when(F.bool_or(s != "complete"), "pending").otherwise("joinable")
    return parts.groupBy(*keys).agg(F.count(F.lit(1)).alias("parts"), out.alias("state"))


def map_drift(stored: DataFrame, current: DataFrame, key: str, column: str) -> DataFrame:
    """(key, name, stored, current): entries of the two maps that differ, absence included."""
    a = stored.select(key, F.explode(column).alias("name", "stored"))
    b = current.select(key, F.explode(column).alias("name", "current"))
    return a.join(b, [key, "name"], "full").filter(~F.col("stored").eqNullSafe(F.col("current"))).select(key, "name", "stored", "current")


def collect_batch(units: DataFrame, results: DataFrame, unit: str, batch: str, per_second: int = 25) -> DataFrame:
    """(batch, state, missing, errors, tokens) of results (unit, failed, tokens, seconds) of units (unit, batch).

    A unit without a result is missing; absent usage is ceil(seconds * per_second) tokens; any missing or failed unit makes the batch 'collected_with_failures'.
    """
    both = units.select(unit, batch).join(results.select(unit, "failed", "tokens", "seconds", F.lit(True).alias("_r")), unit, "left")
    gone, failed = F.col("_r").isNull(), F.coalesce("failed", F.lit(False))
    tokens = F.when(~gone & ~failed, F.coalesce("tokens", F.ceil(F.col("seconds") * per_second)))
    state = F.when(F.bool_or(gone | failed), "collected_with_failures").otherwise("collected")
    return both.groupBy(batch).agg(state.alias("state"), F.count_if(gone).alias("missing"), F.count_if(failed).alias("errors"), F.coalesce(F.sum(tokens), F.lit(0)).alias("tokens"))
