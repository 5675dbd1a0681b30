"""Import decisions, guards by fingerprint, whole contracts, scorecards, reuse and media checks; violations are rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.ordinals import rows_at
from corpusloom.operators import contracts as C
from corpusloom.operators import rules as R

TERMS = "array<struct<term:string,root:string>>"
ENTRIES = f"array<struct<ref:string,text:string,terms:{TERMS}>>"


def fingerprint(rows: DataFrame, scope: str, key: str, text: str) -> DataFrame:
    """(scope, fingerprint): number of rows and the sums of four pieces of their digests; combines before the shuffle and needs no order.

    Equal rows add up, so repeated rows that become other repeated rows differ.
    Null and the empty text differ, and no text runs into its key.
    """
    named = F.coalesce(F.concat(F.length(F.col(key).cast("string")).cast("string"), F.lit(":"), F.col(key).cast("string")), F.lit("-"))
    digest = F.sha2(F.concat(named, F.coalesce(F.concat(F.lit("="), F.col(text)), F.lit("~"))).cast("binary"), 256)
    piece = lambda i: F.conv(F.substring(digest, 15 * i + 1, 15), 16, 10).cast("decimal(38,0)")  # noqa: E731  60 bits: 10**19 rows fit
    sums = [F.sum(piece(i)).cast("string") for i in range(4)]
    return rows.groupBy(scope).agg(F.concat_ws(":", F.count(F.lit(1)).cast("string"), *sums).alias("fingerprint"))


def reimport_decision(stored: DataFrame, incoming: DataFrame, dependents: DataFrame, scope: str, key: str, text: str) -> DataFrame:
    """(scope, action, receipt): 'noop' if nothing differs, 'reject' if it does and the scope has dependents, else 'replace'; the receipt is what then holds."""
    old = fingerprint(stored, scope, key, text).withColumnRenamed("fingerprint", "_a")
    new = fingerprint(incoming, scope, key, text).withColumnRenamed("fingerprint", "_b")
    both = old.join(new, scope, "full").join(dependents.select(scope, F.lit(True).alias("_d")).distinct(), scope, "left")
    action = F.when(F.col("_a").eqNullSafe(F.col("_b")), "noop").when(F.col("_d"), "reject").otherwise("replace")
    return both.select(scope, action.alias("action"), F.when(action == "replace", F.col("_b")).otherwise(F.col("_a")).alias("receipt"))


def frozen_guard(edits: DataFrame, texts: DataFrame, recorded: DataFrame, scope: str, key: str, text: str) -> DataFrame:
    """(key, status) of edits (key, before, expected, unresolved): 'set_differs', 'text_differs', 'count_differs' or 'applied'.

    recorded: scope, fingerprint of its texts when they were frozen.
    """
    now = fingerprint(texts, scope, key, text).withColumnRenamed("fingerprint", "_now")
    both = edits.join(texts.select(key, scope, F.col(text).alias("_t")), key).join(now, scope).join(recorded, scope, "left")
    checks = [("set_differs", F.col("_now") == F.col("fingerprint")), ("text_differs", F.col("_t").eqNullSafe(F.col("before"))), ("count_differs", F.col("unresolved") == F.col("expected"))]
    return both.select(key, C.first_failure(checks, "applied").alias("status"))


def publish(text: Column, phrases: list[tuple[str, str]], words: list[tuple[str, str, str]], fallback: tuple[str, str, str]) -> tuple[Column, Column]:
    """Phrases in order, case as written; then whole words that keep their case; then, for what is left, a pattern (label, pattern, replacement).

    Returns the text and the ``label: count`` of every step that changed something; each step counts on the text before it.
    """
    edits = []
    for old, new in phrases:
        n = R.occurrences(text, F.lit(old))
        edits.append(F.when(n > 0, F.concat(F.lit(f"{old}: "), n.cast("string"))))
        text = F.replace(text, F.lit(old), F.lit(new))
    text, worded = R.rewrite(text, words, R.WORD_EDGES)
    label, pattern, new = fallback
    n = F.regexp_count(text, F.lit(pattern))
    last = F.when(n > 0, F.concat(F.lit(f"{label}: "), n.cast("string")))
    return F.regexp_replace(text, pattern, new), F.concat(F.array_compact(F.array(*edits)), worded, F.array_compact(F.array(last)))


def passage_text(candidates: DataFrame, release: DataFrame, key: str) -> DataFrame:
    """(key, passage, missing, repeated) of candidates (key, coll, first, last) from release rows (coll, seq, text).

    The passage is null where a reference is missing or stands in the release more than once.
    """
    wide = candidates.select(key, "coll", F.explode(F.sequence("first", "last")).alias("seq"))
    found = wide.join(release.select("coll", "seq", "text", F.lit(1).alias("_r")), ["coll", "seq"], "left")
    per = found.groupBy(key, "seq").agg(F.count("_r").alias("_n"), F.first("text").alias("_t"))
    pieces = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "_t"))), lambda p: p["_t"]), " ")
    whole = per.groupBy(key).agg(pieces.alias("_p"), F.count_if(F.col("_n") == 0).alias("missing"), F.count_if(F.col("_n") > 1).alias("repeated"))
    return whole.select(key, F.when((F.col("missing") == 0) & (F.col("repeated") == 0), F.col("_p")).alias("passage"), "missing", "repeated")


def case_results(cases: DataFrame, findings: DataFrame, key: str) -> DataFrame:
    """``cases`` (key, defect, types, least, required) with ``passed``; findings: key, type, severity (a number).

    A defect passes with a finding of an accepted type and at least its least severity, a clean case without any finding of that severity.
    """
    heavy = F.col("severity") >= F.col("least")
    met = cases.join(findings, key, "left").groupBy(*cases.columns).agg(
        F.coalesce(F.bool_or(heavy & F.array_contains("types", F.col("type"))), F.lit(False)).alias("_hit"), F.coalesce(F.bool_or(heavy), F.lit(False)).alias("_any"))
    return met.withColumn("passed", F.when(F.col("defect"), F.col("_hit")).otherwise(~F.col("_any"))).drop("_hit", "_any")


def scorecard(results: DataFrame, recall: float, false_positives: float) -> DataFrame:
    """One row: cases, recall, false_positive_rate, failed required cases, accepted."""
    share = lambda which, hit: F.round(F.try_divide(F.count_if(which & hit), F.count_if(which)), 6)
    row = results.agg(F.count(F.lit(1)).alias("cases"), share(F.col("defect"), F.col("passed")).alias("recall"), share(~F.col("defect"), ~F.col("passed")).alias("false_positive_rate"), F.count_if(F.col("required") & ~F.col("passed")).alias("required_failed"))
    return row.withColumn("accepted", (F.col("recall") >= recall) & (F.col("false_positive_rate") <= false_positives) & (F.col("required_failed") == 0))


def cohort_metrics(df: DataFrame, keys: list[str], metric: str, paired: str, minimum: int) -> DataFrame:
    """Per cohort: known, unknown, the two middle values and their mean, ratio of the sums over rows that have both values, and whether the evidence is enough."""
    both = F.col(metric).isNotNull() & F.col(paired).isNotNull()
    known = F.count(metric)
    ratio = F.try_divide(F.sum(F.when(both, F.col(metric))), F.sum(F.when(both, F.col(paired))))
    sums = df.groupBy(*keys).agg(known.alias("known"), (F.count(F.lit(1)) - known).alias("unknown"), F.round(ratio, 6).alias("paired_rate"), (known >= minimum).alias("enough"))
    middles = sums.select(*keys, F.explode(F.array(F.floor((F.col("known") + 1) / 2), F.floor(F.col("known") / 2) + 1)).alias("_at"))
    found = rows_at(df.filter(F.col(metric).isNotNull()).select(*keys, metric), keys, [metric], middles, "_at")  # in range partitions, not one sort a cohort
    ends = found.groupBy(*keys).agg(F.min(metric).alias("lower"), F.max(metric).alias("upper"))
    same = F.lit(True)
    for k in keys:
        same = same & sums[k].eqNullSafe(ends[k])
    joined = sums.join(ends, same, "left").select(*[sums[k] for k in keys], "known", "unknown", "lower", "upper", "paired_rate", "enough")
    return joined.withColumn("median", F.round((F.col("lower") + F.col("upper")) / 2, 6))


def response_entries(responses: DataFrame, key: str) -> DataFrame:
    """(key, rows) of answers (key, body): a JSON list, or an object with ``translations``, in a code fence, in prose or alone; rows is null if unreadable."""
    found = F.regexp_extract("body", r"(?s)\[.*\]|\{.*\}", 0)
    inside = F.from_json(found, f"struct<translations:{ENTRIES}>")["translations"]
    return responses.select(key, F.when(found.startswith("{"), inside).when(found.startswith("["), F.from_json(found, ENTRIES)).alias("rows"))


def entry_issues(entries: DataFrame, expected: DataFrame, key: str) -> DataFrame:
    """(key, ref, problem): 'unreadable', 'unknown', 'missing', 'duplicate', 'empty' or 'incomplete_term' (an entry of terms without term or root)."""
    unreadable = entries.filter("rows is null").select(key, F.lit(None).cast("string").alias("ref"), F.lit("unreadable").alias("problem"))
    blank = lambda c: F.length(F.trim(F.coalesce(c, F.lit("")))) == 0
    each = entries.select(key, F.explode("rows").alias("e")).select(key, "e.ref", blank(F.col("e.text")).alias("_blank"), F.exists(F.coalesce("e.terms", F.array().cast(TERMS)), lambda t: blank(t["term"]) | blank(t["root"])).alias("_term"))
    given = each.groupBy(key, "ref").agg(F.count(F.lit(1)).alias("_n"), F.bool_or("_blank").alias("_blank"), F.bool_or("_term").alias("_term"))
    both = expected.select(key, "ref", F.lit(True).alias("_e")).join(given, [key, "ref"], "full")
    problem = F.when(F.col("_e").isNull(), "unknown").when(F.col("_n").isNull(), "missing").when(F.col("_n") > 1, "duplicate").when(F.col("_blank"), "empty").when(F.col("_term"), "incomplete_term")
    return both.withColumn("problem", problem).filter("problem is not null").select(key, "ref", "problem").unionByName(unreadable)


def ordered_findings(entries: DataFrame, expected: DataFrame, key: str, seq: str, types: list[str], severities: list[str], severe: list[str]) -> DataFrame:
    """(key, seq, problem) of entries (key, place, seq, type, severity, quote, ground, verdict) against expected (key, seq, text, source).

    A null type is an entry without finding.  Order is judged by rank of place against rank of seq inside the key.
    """
    w = Window.partitionBy(key)
    rows = entries.join(expected, [key, seq], "left").withColumns({"_p": F.row_number().over(w.orderBy("place")), "_s": F.row_number().over(w.orderBy(seq))})
    has = F.col("type").isNotNull()
    omitted = F.col("quote") == "<missing>"
    checks = [
        ("order", F.col("_p") == F.col("_s")),
        ("type", ~has | F.col("type").isin(types)),
        ("severity", ~has | F.col("severity").isin(severities)),
        ("quote", ~has | omitted | C.grounded(F.col("text"), F.col("quote"))),
        ("missing_mark", ~has | ~omitted | (F.col("type") == "omission")),
        ("ground", ~has | C.grounded(F.col("source"), F.col("ground"))),
        ("verdict", has != (F.col("verdict") == "pass")),
        ("severe_without_revise", ~(has & F.col("severity").isin(severe)) | (F.col("verdict") == "revise")),
    ]
    return C.failures(rows, [key, seq], checks)


def audit_issues(audits: DataFrame, key: str, fields: list[str], candidates: list[str]) -> DataFrame:
    """(key, problem) of blind audits (key, order, scores): candidates in the order given, scores for just the closed fields, each from 1 to 5."""
    names = F.map_keys("scores")
    checks = [
        ("candidate_order", F.col("order") == F.array(*map(F.lit, candidates))),
        ("missing_score", F.size(F.array_except(F.array(*map(F.lit, fields)), names)) == 0),
        ("unknown_score", F.size(F.array_except(names, F.array(*map(F.lit, fields)))) == 0),
        ("score_range", F.forall(F.map_values("scores"), lambda s: s.between(1, 5))),
    ]
    return C.failures(audits, [key], checks)


def decision_fields(findings: DataFrame, decisions: DataFrame, key: str, allowed: list[str]) -> DataFrame:
    """(key, problem): exactly one decision per finding, its value allowed and its reason not blank."""
    d = decisions.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.bool_and(F.coalesce(F.col("decision").isin(allowed), F.lit(False))).alias("_ok"), F.bool_and(F.length(F.trim(F.coalesce("reason", F.lit("")))) > 0).alias("_why"))
    both = findings.select(key, F.lit(True).alias("_f")).distinct().join(d, key, "full")
    none = F.col("_n").isNull()
    return C.failures(both, [key], [("unknown_finding", F.col("_f")), ("undecided", ~none), ("decided_twice", none | (F.col("_n") == 1)), ("decision", none | F.col("_ok")), ("reason", none | F.col("_why"))])


def gated_layers(base: DataFrame, revisions: DataFrame, repairs: DataFrame, critic: DataFrame, verification: DataFrame, overrides: DataFrame, key: str) -> DataFrame:
    """(key, final_text, layer): the repair where the verification has findings, else the revision where the critic has, else the draft; then the override of the key's group."""
    flag = lambda df, name: df.select(key, F.lit(True).alias(name)).distinct()
    joined = base.select(key, "text")
    for df, name in ((revisions, "_rev"), (repairs, "_rep"), (overrides, "_over")):
        joined = joined.join(df.select(key, F.col("text").alias(name)), key, "left")
    joined = joined.join(flag(critic, "_c"), key, "left").join(flag(verification, "_v"), key, "left")
    layer = F.when(F.col("_over").isNotNull(), "group").when(F.col("_v") & F.col("_rep").isNotNull(), "repair").when(F.col("_c") & F.col("_rev").isNotNull(), "revision").otherwise("draft")
    text = F.when(layer == "group", F.col("_over")).when(layer == "repair", F.col("_rep")).when(layer == "revision", F.col("_rev")).otherwise(F.col("text"))
    return joined.select(key, text.alias("final_text"), layer.alias("layer"))


def seed_status(units: DataFrame, prior: DataFrame, key: str, inputs: list[str]) -> DataFrame:
    """(key, status) of units (key, unit_hash, model, inputs) against prior results with the same columns and a result.

    'new', the first of 'unit', 'model' or an input that differs, 'invalid' for a blank result, or 'reused'.
    """
    names = ["unit_hash", "model", *inputs]
    old = prior.select(key, *[F.col(n).alias(f"_{n}") for n in names], "result", F.lit(True).alias("_p"))
    both = units.join(old, key, "left")
    checks = [("new", F.col("_p")), *[(n, F.col(n).eqNullSafe(F.col(f"_{n}"))) for n in names], ("invalid", F.length(F.trim("result")) > 0)]
    return both.select(key, C.first_failure(checks, "reused").alias("status"))


def rejudged(attempts: DataFrame, keys: list[str], attempt: str, old: Column, new: Column) -> DataFrame:
    """(keys, before, after): the first attempt that passed under the old rule and the first that passes under the amended one, judged again on what is stored."""
    first = lambda rule: F.min(F.when(rule, F.col(attempt)))
    return attempts.groupBy(*keys).agg(first(old).alias("before"), first(new).alias("after"))


def neighbour_texts(rows: DataFrame, texts: DataFrame, scope: str, place: str, text: str, letters: int) -> DataFrame:
    """``rows`` with the first letters of the texts one place before and after, inside their scope; two equi-joins."""
    for name, step in (("before", 1), ("after", -1)):
        near = texts.select(scope, (F.col(place) + step).alias(place), F.left(F.col(text), F.lit(letters)).alias(name))
        rows = rows.join(near, [scope, place], "left")
    return rows
