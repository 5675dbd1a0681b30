"""Duplicate groups, finding contracts, layered resolution and table maintenance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.storage import written
from corpusloom.functions.texts import even_spaces, normal_form
from corpusloom.operators.rules import occurrences


def folded(text: Column) -> Column:
    """Lower-cased, white space evened: how quotes are compared with texts."""
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def normalized(text: Column, without: str = "") -> Column:
    """Unicode form NFC and even white space; case and marks stay, as they are part of what is said. ``without``: characters that are only ornament."""
    return even_spaces(F.translate(normal_form(text), without, ""))


def group_ids(df: DataFrame, key: str, text: str, without: str = "") -> DataFrame:
    """(key, group_id) of every row, groups of one included: one scan, no shuffle; enough where a lone row cannot matter."""
    return df.select(key, F.sha2(normalized(F.col(text), without), 256).alias("group_id"))


def duplicate_groups(df: DataFrame, key: str, text: str, without: str = "") -> DataFrame:
    """(group_id, key, size): members of groups of equal normalized texts.

    Texts are normalized once, into a written table of digests; sizes are counted first, no member list is built.
    """
    hashed = written(group_ids(df, key, text, without), "groups")
    sizes = hashed.groupBy("group_id").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    return hashed.join(sizes, "group_id")


def invariance(groups: DataFrame, texts: DataFrame, key: str, text: str) -> DataFrame:
    """Per group with two present texts or more: how many renderings there are, and whether it is one."""
    present = groups.join(texts.filter(F.col(text).isNotNull()), key)
    out = present.groupBy("group_id").agg(F.count(F.lit(1)).alias("present"), F.count_distinct(text).alias("renderings"))
    return out.filter("present > 1").withColumn("invariant", F.col("renderings") == 1)


def closure(targets: DataFrame, groups: DataFrame, key: str) -> DataFrame:
    """Targets and all members of their groups; ``closure_only`` marks the added ones."""
    hit = groups.join(targets.select(key), key, "left_semi").select("group_id").distinct()
    members = groups.join(hit, "group_id", "left_semi").select(key)
    return members.join(targets, key, "left_anti").distinct().withColumn("closure_only", F.lit(True)).unionByName(targets.select(key).distinct().withColumn("closure_only", F.lit(False)))


def guarded_edit(df: DataFrame, text: str, before: str, after: str) -> DataFrame:
    """Apply an edit only if ``before`` occurs exactly once: columns new_text and status ('applied', 'missing', 'ambiguous', 'no_text', or 'no_before' where there is nothing to look for)."""
    n = occurrences(F.col(text), F.col(before))
    status = F.when(F.col(text).isNull(), "no_text").when(n.isNull(), "no_before").when(n == 1, "applied").when(n == 0, "missing").otherwise("ambiguous")
    new = F.when(F.coalesce(n == 1, F.lit(False)), F.replace(F.col(text), F.col(before), F.col(after))).otherwise(F.col(text))
    return df.withColumn("status", status).withColumn("new_text", new)


def accept_gated(base: DataFrame, revised: DataFrame, verdicts: DataFrame, key: str) -> DataFrame:
    """The revision's text where its verification accepts, else the base text; base: key, text; revised: key, revision; verdicts: key, accept."""
    joined = base.join(revised, key, "left").join(verdicts, key, "left")
    wins = F.coalesce(F.col("accept"), F.lit(False)) & F.col("revision").isNotNull()
    return joined.withColumn("final_text", F.when(wins, F.col("revision")).otherwise(F.col("text"))).withColumn("layer", F.when(wins, "revision").otherwise("base"))


def staged_overlay(base: DataFrame, layers: list[tuple[str, DataFrame]], key: str) -> DataFrame:
    """The text of the last layer that has one; layers: (name, (key, text)) from first to last."""
    out = base.select(key, F.col("text").alias("final_text"), F.lit("draft").alias("layer"))
    for name, layer in layers:
        joined = out.join(layer.select(key, F.col("text").alias("_t")), key, "left")
        out = joined.select(key, F.coalesce("_t", "final_text").alias("final_text"), F.when(F.col("_t").isNotNull(), name).otherwise(F.col("layer")).alias("layer"))
    return out


def latest_wins(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key: the first along ``order``."""
    place = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_k", F.row_number().over(place)).filter("_k = 1").drop("_k")


def decision_contract(findings: DataFrame, decisions: DataFrame, key: str) -> DataFrame:
    """(key, problem): findings without exactly one decision, decisions without a finding."""
    f = findings.groupBy(key).agg(F.count(F.lit(1)).alias("f"))
    d = decisions.groupBy(key).agg(F.count(F.lit(1)).alias("d"))
    both = f.join(d, key, "full").select(key, F.coalesce("f", F.lit(0)).alias("f"), F.coalesce("d", F.lit(0)).alias("d"))
    problem = F.when(F.col("f") == 0, "unknown_finding").when(F.col("d") == 0, "undecided").when(F.col("d") > 1, "decided_twice")
    return both.withColumn("problem", problem).filter("problem is not null").select(key, "problem")


def verdict(issues: DataFrame) -> DataFrame:
    """One row: errors, warnings, passed."""
    return issues.agg(F.count_if(F.col("severity") == "error").alias("errors"), F.count_if(F.col("severity") == "warning").alias("warnings")).withColumn("passed", F.col("errors") == 0)


def adjudicate(texts: DataFrame, edits: DataFrame, key: str, stamp: str) -> DataFrame:
    """(key, status, text, provenance) of guarded edits that may be applied again.

    texts: key, text, provenance (struct, see below; null before the first edit).  edits: key, action ('change' or 'retain'), before, after,
    expected, category, rationale; one a key.  ``stamp``: digest of the table of edits.
    A change applies where ``before`` stands once ('changed'); where it stands nowhere and ``after`` does, the text
    must be what this very table of edits left ('already_applied'), else 'after_without_provenance'; any other count is 'before_guard'.
    'retained' where ``expected`` stands, else 'retain_guard'; 'missing_text' without a text, 'unknown_action' for any other action.
    provenance: action, category, source (the text before the last change), text, rationale, stamp; kept as it was where the edit fails.
    """
    joined = edits.join(texts.select(key, "text", "provenance"), key, "left")
    t, was = F.col("text"), F.col("provenance")
    n = occurrences(t, F.col("before"))
    traced = (was["stamp"] == stamp) & (was["text"] == t)
    change = (
        F.when(n == 1, "changed")
        .when((n == 0) & F.contains(t, F.col("after")), F.when(F.coalesce(traced, F.lit(False)), "already_applied").otherwise("after_without_provenance"))
        .otherwise("before_guard")
    )
    retain = F.when(F.contains(t, F.col("expected")), "retained").otherwise("retain_guard")
    status = F.when(t.isNull(), "missing_text").when(F.col("action") == "change", change).when(F.col("action") == "retain", retain).otherwise("unknown_action")
    judged = joined.withColumn("status", status)
    new = F.when(F.col("status") == "changed", F.replace(t, F.col("before"), F.col("after"))).otherwise(t)
    good = F.col("status").isin("changed", "already_applied", "retained")
    source = F.when(F.col("status") == "changed", t).otherwise(F.coalesce(was["source"], t))
    trace = F.struct("action", "category", source.alias("source"), new.alias("text"), "rationale", F.lit(stamp).alias("stamp"))
    return judged.select(key, "status", new.alias("text"), F.when(good, trace).otherwise(was.cast(PROVENANCE)).alias("provenance"))


PROVENANCE = "struct<action:string,category:string,source:string,text:string,rationale:string,stamp:string>"


def unresolved(revised: DataFrame, verdicts: DataFrame, findings: DataFrame, decisions: DataFrame, key: str, severe: list[str]) -> DataFrame:
    """(key, kind, finding_id, reason): what an accept-gated layer leaves open.

    'rejected_revision': a revision whose verification does not accept, with its reason (revised: key; verdicts: key, accept, reason).
    'open_finding': a severe finding (findings: finding_id, key, severity) whose decision (decisions: finding_id, decision) is
    'escalated' or missing, or whose text has no accepting verification, with the first of these as reason.
    """
    judged = revised.select(key).distinct().join(verdicts, key).filter(~F.coalesce("accept", F.lit(False)))
    rejected = judged.select(key, F.lit("rejected_revision").alias("kind"), F.lit(None).cast("string").alias("finding_id"), "reason")
    grave = findings.filter(F.col("severity").isin(severe)).join(decisions, "finding_id", "left").join(verdicts.select(key, "accept"), key, "left")
    why = F.when(F.col("decision").isNull(), "undecided").when(F.col("decision") == "escalated", "escalated").when(F.col("accept").isNull(), "unverified").when(~F.col("accept"), "not_accepted")
    left = grave.withColumn("reason", why).filter("reason is not null").select(key, F.lit("open_finding").alias("kind"), F.col("finding_id").cast("string").alias("finding_id"), "reason")
    return rejected.unionByName(left)


def accept_status(severe: Column, accept: Column) -> Column:
    """'accepted_with_severe', 'rejected_without_severe' or 'ok'."""
    return F.when(accept & severe, "accepted_with_severe").when(~accept & ~severe, "rejected_without_severe").otherwise("ok")


def disposition(severity: Column, severe: list[str], decision: Column, accept: Column) -> Column:
    """'advisory' for what is not severe, else 'repaired_and_verified', 'rejected_base_verified' or 'unresolved_fallback'."""
    ok = F.coalesce(accept, F.lit(False))
    return F.when(~severity.isin(severe), "advisory").when((decision == "applied") & ok, "repaired_and_verified").when((decision == "rejected") & ok, "rejected_base_verified").otherwise("unresolved_fallback")


def finding_id(parts: list[str], prefix: str = "qa-", digits: int = 16) -> Column:
    """An id that depends on what a finding says: the first hexadecimal digits of a digest of its parts."""
    return F.concat(F.lit(prefix), F.substring(F.sha2(F.concat_ws("|", *parts).cast("binary"), 256), 1, digits))


def decided(findings: DataFrame, decisions: DataFrame, verdicts: DataFrame, finding: str, key: str) -> DataFrame:
    """Findings with their decision (by finding) and the verdict on their text (by key); null where there is none."""
    return findings.join(decisions.select(finding, "decision"), finding, "left").join(verdicts.select(key, "accept"), key, "left")


def final_merge(base: DataFrame, overlay: DataFrame, targets: DataFrame, key: str) -> DataFrame:
    """(key, value, guard): the overlay's value where there is one; the keys overlaid must be the targets: 'not_a_target', 'target_left_out' or 'ok'."""
    over = overlay.select(key, F.col("value").alias("_new"), F.lit(True).alias("_o"))
    wanted = targets.select(key, F.lit(True).alias("_t")).distinct()
    both = base.join(over, key, "left").join(wanted, key, "left")
    guard = F.when(F.col("_o").isNotNull() & F.col("_t").isNull(), "not_a_target").when(F.col("_o").isNull() & F.col("_t"), "target_left_out").otherwise("ok")
    return both.select(key, F.when(F.col("_o"), F.col("_new")).otherwise(F.col("value")).alias("value"), guard.alias("guard"))


def canonical_labels(df: DataFrame, generic: Column, text: str, label: str, operation: str = "replaced_generic_label") -> DataFrame:
    """``df`` with ``label`` replaced by the whole text where it is generic, and the ``operation`` that did so, else null."""
    return df.withColumn("operation", F.when(generic, operation)).withColumn(label, F.when(generic, F.col(text)).otherwise(F.col(label)))


def versioned_text(version: Column, unchanged: str, text: Column, rewritten: Column) -> Column:
    """The text as it is for runs whose version begins with ``unchanged``, else the rewritten one."""
    return F.when(version.startswith(unchanged), text).otherwise(rewritten)
