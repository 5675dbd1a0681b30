"""Scores, costs, cohorts and schedules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.ordinals import rows_at


def weighted_score(values: dict[str, Column], weights: dict[str, int]) -> Column:
    """Integer scores 1 to 5 under weights that sum to 100: a number to 100 with one digit; null if a score is out of range."""
    ok = F.lit(True)
    total = F.lit(0)
    for k, w in weights.items():
        ok, total = ok & values[k].between(1, 5), total + values[k] * w
    return F.when(ok, F.round(total / 5.0, 1))


def word_count(text: Column) -> Column:
    return F.size(F.regexp_extract_all(text, F.lit(r"[A-Za-z0-9']+"), F.lit(0))).cast("long")


def reading_seconds(words: Column, words_per_minute: float) -> Column:
    return F.round(words * 60.0 / words_per_minute, 1)


def usage_cost(df: DataFrame, prices: DataFrame) -> DataFrame:
    """Cost of a usage row by model; cached input is part of the input and priced by its own rate. Models without a price keep a null cost."""
    plain = F.col("input_tokens") - F.col("cached_tokens")
    cost = (plain * F.col("input_rate") + F.col("cached_tokens") * F.col("cached_rate") + F.col("output_tokens") * F.col("output_rate")) / 1e6
    return df.join(F.broadcast(prices), "model", "left").withColumn("cost", F.round(cost, 8))


def request_ceiling(text: Column, max_out: int, input_rate: float | Column, output_rate: float | Column, creation_rate: float | Column | None = None) -> Column:
    """Upper bound of a request's cost: a token for two UTF-8 bytes at least, at the dearer of the rates of input and of what is put into a cache, plus all output allowed."""
    tokens = F.greatest(F.lit(1), F.floor(F.octet_length(text) / 2))
    col = lambda x: x if isinstance(x, Column) else F.lit(x)
    rate = col(input_rate) if creation_rate is None else F.greatest(col(input_rate), col(creation_rate))
    return F.round((tokens * rate + F.lit(max_out) * col(output_rate)) / 1e6, 8)


def best_snapshot(df: DataFrame, keys: list[str], age: Column, centre: float, tie: list[str]) -> DataFrame:
    """Per key the observation whose age is nearest to ``centre``; ties by ``tie``."""
    near = F.abs(age - centre)
    place = Window.partitionBy(*keys).orderBy(near, *tie)
    return df.withColumn("_k", F.row_number().over(place)).filter("_k = 1").drop("_k")


def cohort_summary(df: DataFrame, keys: list[str], metric: str, minimum: int) -> DataFrame:
    """Known and unknown counts, exact median of the known, and whether the evidence is enough."""
    known = F.count(metric)
    return df.groupBy(*keys).agg(known.alias("known"), (F.count(F.lit(1)) - known).alias("unknown"), F.round(F.median(metric), 6).alias("median"), (known >= minimum).alias("enough"))


def nearest_rank(df: DataFrame, keys: list[str], value: str, share: float) -> DataFrame:
    """The value at 0-based rank round(share * (n - 1)), half to even; nulls rank first.

    Ranks are found in range partitions of (keys, value), so a key that holds most rows is many tasks' work.
    """
    at = (F.bround(F.lit(share) * (F.count(F.lit(1)) - 1)) + 1).cast("long")
    wanted = df.groupBy(*keys).agg(at.alias("_at"))
    return rows_at(df.select(*keys, value), keys, [value], wanted, "_at").select(*keys, F.col(value).alias("p"))


def even_sample(df: DataFrame, keys: list[str], order: list[str], size: int) -> DataFrame:
    """Of each key the rows at 0-based places round(i * (n - 1) / (size - 1)) along ``order``, half to even, each once."""
    i = F.explode(F.sequence(F.lit(0), F.lit(size - 1)))
    spread = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).withColumn("_i", i)
    wanted = spread.select(*keys, (F.bround(F.col("_i") * (F.col("_n") - 1) / float(size - 1)) + 1).cast("long").alias("_at"))
    return rows_at(df, keys, order, wanted, "_at").drop("_at")


def transport_cost(usage: DataFrame, prices: DataFrame) -> DataFrame:
    """``usage`` with ``cost``, rounded to eight digits; null where the model has no price.

    usage: model, input, output, cached, created, thoughts, reported (numbers, null is none).  prices: model, transport,
    input_rate, output_rate, cached_rate, creation_rate, each per million tokens; a null cache rate is the input rate.
    Transports: 'separate' counts cached and created tokens beside the input; all others count cached tokens inside it;
    'thinking' pays thoughts as output; 'reported' takes the reported cost where there is one.
    """
    n = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    cached, created = F.coalesce("cached_rate", "input_rate"), F.coalesce("creation_rate", "input_rate")
    separate = F.col("transport") == "separate"
    plain = F.when(separate, n("input")).otherwise(F.greatest(F.lit(0.0), n("input") - n("cached")))
    out = n("output") + F.when(F.col("transport") == "thinking", n("thoughts")).otherwise(0.0)
    paid = plain * F.col("input_rate") + n("cached") * cached + F.when(separate, n("created") * created).otherwise(0.0) + out * F.col("output_rate")
    told = (F.col("transport") == "reported") & F.col("reported").isNotNull()
    rates = ["transport", "input_rate", "output_rate", "cached_rate", "creation_rate"]
    return usage.join(F.broadcast(prices.select("model", *rates)), "model", "left").withColumn("cost", F.round(F.when(told, F.col("reported").cast("double")).otherwise(paid / 1e6), 8)).drop(*rates)


#: The names under which answers count their tokens, the first that is there holds.
USAGE_NAMES = {
    "input": ["input_tokens", "prompt_tokens", "prompt_token_count"],
    "output": ["output_tokens", "completion_tokens", "candidates_token_count"],
    "cached": ["cache_read_input_tokens", "input_tokens_details.cached_tokens", "cached_content_token_count"],
    "created": ["cache_creation_input_tokens"],
    "thoughts": ["thoughts_token_count"],
    "reported": ["cost"],
}


def usage_numbers(answer: Column) -> list[Column]:
    """The token counts of a JSON usage object, or of one inside it under ``usage``, as the columns that ``transport_cost`` takes."""
    at = lambda path: F.get_json_object(answer, f"$.{path}").cast("double")
    find = lambda names: F.coalesce(*[at(f"{deep}{name}") for name in names for deep in ("", "usage.")])
    nonzero = lambda names: F.coalesce(*[F.nullif(at(f"{deep}{name}"), F.lit(0.0)) for name in names for deep in ("", "usage.")])
    return [(nonzero(names) if key == "cached" else find(names)).alias(key) for key, names in USAGE_NAMES.items()]


def full_scale(df: DataFrame, keys: list[str], sampled: Column, measured: str, size: str, rate: float, spread: float) -> DataFrame:
    """(keys, ratio, estimate, price, low, high): what was measured on the sample, per unit of size, carried to all rows and priced, with a range of ``spread`` to both sides.

    A key without a sampled row, or whose sample has no size, has nulls.
    """
    part = lambda c: F.sum(F.when(sampled, F.col(c)))
    per = df.groupBy(*keys).agg(F.try_divide(part(measured), part(size)).alias("ratio"), F.sum(size).alias("_all"))
    estimate = F.col("ratio") * F.col("_all")
    money = lambda x: F.round(x, 6)
    return per.select(*keys, F.round("ratio", 8).alias("ratio"), F.round(estimate, 4).alias("estimate"), money(estimate * rate).alias("price"), money(estimate * rate * (1 - spread)).alias("low"), money(estimate * rate * (1 + spread)).alias("high"))


def closed_score(scores: Column, weights: dict[str, int]) -> tuple[Column, Column]:
    """(score, problem) of a map of integer scores under weights: just the named keys, each from 1 to 5, weights that sum to 100.

    Score: round(sum of score * weight / 5, 1), null with a problem: 'missing_key', 'unknown_key' or 'out_of_range'.
    """
    if sum(weights.values()) != 100:
        raise ValueError("weights must sum to 100")
    names = F.array(*map(F.lit, weights))
    given = F.map_keys(scores)
    problem = (
        F.when(scores.isNull() | (F.size(F.array_except(names, given)) > 0), "missing_key")
        .when(F.size(F.array_except(given, names)) > 0, "unknown_key")
        .when(~F.forall(F.map_values(scores), lambda s: F.coalesce(s.between(1, 5), F.lit(False))), "out_of_range")
    )
    total = sum((F.element_at(scores, F.lit(k)) * w for k, w in weights.items()), F.lit(0))
    return F.when(problem.isNull(), F.round(total / 5.0, 1)), problem


def agreement(findings: DataFrame, judges: int, keys: list[str], weights: dict[str, float]) -> DataFrame:
    """(keys, found_by, consensus, severity, weight): of what several judges found, whether all did, the gravest severity and the weight of all.

    findings: keys (candidate, passage, place, type or others), judge, severity; ``weights``: of each severity, from the lightest to the gravest.
    """
    weigh = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in weights.items() for x in kv]), F.col("severity")), F.lit(0.0))
    out = findings.withColumn("_w", weigh).groupBy(*keys).agg(F.count_distinct("judge").alias("found_by"), F.max_by("severity", "_w").alias("severity"), F.sum("_w").alias("weight"))
    return out.withColumn("consensus", F.col("found_by") == judges)


def stage_matrix(rows: DataFrame, stages: list[tuple[str, Column]], unit: str) -> DataFrame:
    """(stage, required, complete, failed, pending): one row a stage; rows: unit, stage, status and what the conditions need.

    A stage is required of the units for which its condition holds on some row; 'complete' and 'failed' count its required units by their
    best status, 'pending' those with neither.
    """
    per = rows.groupBy(unit).agg(*[F.bool_or(F.coalesce(need, F.lit(False))).alias(f"_n{i}") for i, (_, need) in enumerate(stages)],
                                 *[F.bool_or((F.col("stage") == s) & (F.col("status") == what)).alias(f"_{what}{i}") for i, (s, _) in enumerate(stages) for what in ("complete", "failed")])
    told = F.array(*[F.struct(F.lit(s).alias("stage"), F.col(f"_n{i}").alias("need"), F.coalesce(f"_complete{i}", F.lit(False)).alias("done"), F.coalesce(f"_failed{i}", F.lit(False)).alias("bad")) for i, (s, _) in enumerate(stages)])
    each = per.select(F.explode(told).alias("s")).select("s.*")
    need, done, bad = F.col("need"), F.col("done"), F.col("bad")
    return each.groupBy("stage").agg(F.count_if(need).alias("required"), F.count_if(need & done).alias("complete"), F.count_if(need & ~done & bad).alias("failed"), F.count_if(need & ~done & ~bad).alias("pending"))
