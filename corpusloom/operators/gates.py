"""Gates over texts, groups, manifests, catalogs, captions and timelines; every violation is a row, no rows is a pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.operators import contracts as C
from corpusloom.operators import resolve as V
from corpusloom.operators import rules as R


def coverage_gate(expected: DataFrame, texts: DataFrame, key: str, text: str) -> DataFrame:
    """(key, code, severity): expected keys without a row ('missing') and rows with a null or blank text ('empty')."""
    e = F.lit("error").alias("severity")
    missing = expected.join(texts.select(key), key, "left_anti").select(key, F.lit("missing").alias("code"), e)
    blank = texts.filter(F.trim(F.coalesce(F.col(text), F.lit(""))) == "")
    return missing.unionByName(blank.select(key, F.lit("empty").alias("code"), e))


def divergence(groups: DataFrame, texts: DataFrame, key: str, text: str) -> DataFrame:
    """(key, code, severity): present members of duplicate groups (group_id, key) that do not all read alike.

    A group's texts are compared by the least and the greatest digest, which
    combine before the shuffle however large the group is.
    """
    present = groups.select("group_id", key).join(texts.filter(F.col(text).isNotNull()).select(key, F.sha2(text, 256).alias("_h")), key)
    split = present.groupBy("group_id").agg(F.min("_h").alias("a"), F.max("_h").alias("b")).filter("a <> b").select("group_id")
    return present.join(split, "group_id", "left_semi").select(key, F.lit("group_divergence").alias("code"), F.lit("error").alias("severity"))


def text_gate(expected: DataFrame, texts: DataFrame, key: str, text: str, rules: dict[str, tuple[str, str]], groups: DataFrame | None = None) -> DataFrame:
    """Coverage, blanks, rules and, if groups are given, divergence of one layer of texts."""
    out = coverage_gate(expected, texts, key, text).unionByName(R.rule_issues(texts, key, text, rules))
    return out if groups is None else out.unionByName(divergence(groups, texts, key, text))


def term_issues(texts: DataFrame, key: str, text: str, terms: list[str]) -> DataFrame:
    """One row per banned term that a text holds, the term in the code."""
    found = F.split(R.banned_terms(F.col(text), terms), ",")
    rows = texts.select(key, F.explode(found).alias("t")).filter("t <> ''")
    return rows.select(key, F.concat(F.lit("banned:"), "t").alias("code"), F.lit("error").alias("severity"))


def elliptical(text: Column, ground: Column, mark: str = r"\.\.\.") -> Column:
    """Whether the parts of a ground, parted by dots, stand in a text in their order, case and typographic quotes aside; null or blank grounds nothing."""
    fold = lambda c: F.translate(F.lower(c), "‘’“”", "''\"\"")
    parts, whole = F.split(fold(ground), mark), fold(text)

    def step(at: Column, part: Column) -> Column:
        found = F.position(part, whole, at)
        return F.when((at == 0) | (F.length(part) == 0), at).when(found > 0, found + F.length(part)).otherwise(0)

    some = F.exists(parts, lambda p: F.length(F.trim(p)) > 0)
    return F.coalesce(some & (F.aggregate(parts, F.lit(1), step) > 0), F.lit(False))


def remediation_issues(targets: DataFrame, decisions: DataFrame, key: str) -> DataFrame:
    """(key, problem) of decisions (key, applied, new_text) on targets (key, group_id, text).

    Problems: 'undecided', 'unknown_target', 'applied_without_change',
    'changed_without_applying', and 'group_divergence' where decided texts of a
    group differ.  A null group_id belongs to no group.
    """
    d = decisions.select(key, "applied", "new_text", F.lit(True).alias("_d"))
    both = targets.select(key, "group_id", "text", F.lit(True).alias("_t")).join(d, key, "full")
    changed = ~F.col("text").eqNullSafe(F.col("new_text"))
    problem = C.first_failure(
        [
            ("unknown_target", F.col("_t").isNotNull()),
            ("undecided", F.col("_d").isNotNull()),
            ("applied_without_change", ~F.col("applied") | changed),
            ("changed_without_applying", F.col("applied") | ~changed),
        ]
    )
    single = both.select(key, problem.alias("problem")).filter("problem <> 'pass'")
    groups = targets.filter("group_id is not null").select("group_id", key)
    return single.unionByName(divergence(groups, decisions, key, "new_text").select(key, F.col("code").alias("problem")))


def group_triage(groups: DataFrame, texts: DataFrame, policies: DataFrame, key: str, text: str) -> DataFrame:
    """(first, members, options, status) per group: 'policy' (a choice is recorded), 'invariant', or 'work_item' with its number of readings."""
    per = groups.select("group_id", key).join(texts.select(key, F.sha2(text, 256).alias("_h")), key)
    per = per.groupBy("group_id").agg(F.min(key).alias("first"), F.count(F.lit(1)).alias("members"), F.count_distinct("_h").alias("options"))
    status = F.when(F.col("_p").isNotNull(), "policy").when(F.col("options") <= 1, "invariant").otherwise("work_item")
    return per.join(policies.select("group_id", F.lit(True).alias("_p")).distinct(), "group_id", "left").select("first", "members", "options", status.alias("status"))


def remediation_targets(issues: DataFrame, groups: DataFrame, key: str) -> DataFrame:
    """(key, closure_only, codes): keys with errors and the members of their groups; codes sorted and comma-joined, empty for added members."""
    errors = issues.filter(F.col("severity") == "error")
    codes = errors.groupBy(key).agg(F.array_join(F.array_sort(F.collect_set("code")), ",").alias("codes"))  # a closed list of codes
    return V.closure(errors.select(key), groups, key).join(codes, key, "left").withColumn("codes", F.coalesce("codes", F.lit("")))


def timeline_gate(words: DataFrame, unit: str, item: str, order: list[str], whole: float = 0.95, part: float = 0.90, slack: float = 0.002) -> DataFrame:
    """(unit, problem) of words (mapped, start, end, duration): share mapped of the unit and of each item, order and bounds."""
    w = words.withColumn("_p", F.lag("end").over(Window.partitionBy(unit).orderBy(*order)))
    late = F.coalesce(F.bool_or(F.col("start") < F.col("_p") - slack), F.lit(False))
    out = F.bool_or((F.col("start") < -slack) | (F.col("end") > F.col("duration") + slack))
    mapped = F.count_if("mapped")
    items = w.groupBy(unit, item).agg(mapped.alias("m"), F.count(F.lit(1)).alias("n"), late.alias("late"), out.alias("out"))
    per = items.groupBy(unit).agg((F.sum("m") / F.sum("n")).alias("whole"), F.min(F.col("m") / F.col("n")).alias("part"), F.bool_or("late").alias("late"), F.bool_or("out").alias("out"))
    return C.failures(per, [unit], [("unit_coverage", F.col("whole") >= whole), ("item_coverage", F.col("part") >= part), ("order", ~F.col("late")), ("bounds", ~F.col("out"))])


def manifest_gate(items: DataFrame, manifest: DataFrame, unit: str, order: str, text: str) -> DataFrame:
    """(unit, problem) of a manifest (unit, digest, chars, n) against the texts of its units joined by line ends; units are packed, hence small."""
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, text))), lambda x: x[text]), "\n")
    made = items.groupBy(unit).agg(joined.alias("t"), F.count(F.lit(1)).alias("_n"))
    both = made.select(unit, F.sha2("t", 256).alias("_d"), F.length("t").alias("_c"), "_n").join(manifest, unit, "full")
    missing = F.col("digest").isNull()
    checks = [
        ("not_listed", ~missing),
        ("no_items", F.col("_d").isNotNull()),
        ("text", missing | F.col("_d").isNull() | (F.col("digest") == F.col("_d"))),
        ("chars", missing | F.col("_d").isNull() | (F.col("chars") == F.col("_c"))),
        ("count", missing | F.col("_d").isNull() | (F.col("n") == F.col("_n"))),
    ]
    return C.failures(both, [unit], checks)


def catalog_gate(segments: DataFrame, catalog: str, segment: str, position: str, expected: str) -> DataFrame:
    """(catalog, problem): a segment listed twice, positions with gaps or repeats, a number of segments other than expected."""
    each = segments.groupBy(catalog, segment).agg(F.count(F.lit(1)).alias("n"), F.min(position).alias("a"), F.max(position).alias("b"), F.max(expected).alias("e"))
    places = segments.groupBy(catalog).agg(F.count_distinct(position).alias("places"))
    per = each.groupBy(catalog).agg(F.max("n").alias("times"), F.sum("n").alias("n"), F.min("a").alias("a"), F.max("b").alias("b"), F.max("e").alias("e")).join(places, catalog)
    contiguous = (F.col("places") == F.col("n")) & (F.col("b") - F.col("a") + 1 == F.col("n"))
    return C.failures(per, [catalog], [("repeated_segment", F.col("times") == 1), ("not_contiguous", contiguous), ("count", F.col("n") == F.col("e"))])


def checklist_gate(df: DataFrame, key: str, checklist: Column, required: list[str]) -> DataFrame:
    """(key, item, problem) of a map item -> boolean: required items absent or not true, and items nobody asked for."""
    need = F.array(*map(F.lit, required))
    flat = df.select(key, checklist.alias("_m"))
    asked = flat.select(key, F.explode(need).alias("item"), "_m").select(key, "item", F.try_element_at("_m", F.col("item")).alias("v"), F.map_contains_key("_m", F.col("item")).alias("has"))
    broken = asked.select(key, "item", F.when(~F.coalesce("has", F.lit(False)), "absent").when(~F.coalesce("v", F.lit(False)), "not_true").alias("problem")).filter("problem is not null")
    extra = flat.select(key, F.explode(F.array_except(F.map_keys("_m"), need)).alias("item")).withColumn("problem", F.lit("unknown_item"))
    return broken.unionByName(extra)


def caption_gate(captions: DataFrame, clips: DataFrame, key: str) -> DataFrame:
    """(key, problem) of captions (key, cue, start, end, caption) against clips (key, text, clip_start, clip_end); a clip's captions are few."""
    c = captions.withColumn("_p", F.lag("end").over(Window.partitionBy(key).orderBy("cue")))
    words = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("cue", "caption"))), lambda x: x["caption"]), " ")
    late = F.coalesce(F.bool_or((F.col("start") < F.col("_p")) | (F.col("end") <= F.col("start"))), F.lit(False))
    per = c.groupBy(key).agg(words.alias("_w"), late.alias("_late"), F.min("start").alias("_a"), F.max("end").alias("_b"))
    both = clips.join(per, key, "left")
    none = F.col("_w").isNull()
    checks = [("no_captions", ~none), ("text", none | (F.col("_w") == F.col("text"))), ("overlap", none | ~F.col("_late")), ("outside", none | ((F.col("_a") >= F.col("clip_start")) & (F.col("_b") <= F.col("clip_end"))))]
    return C.failures(both, [key], checks)


def span_times(chars: DataFrame, keys: list[str], position: str) -> DataFrame:
    """(keys, start, end, n): a span starts with its first character and ends with its last."""
    first, last = F.min_by("start", position), F.max_by("end", position)
    return chars.groupBy(*keys).agg(first.alias("start"), last.alias("end"), F.count(F.lit(1)).alias("n"))


def resplit(rows: DataFrame, keys: list[str], order: list[Column], cost: str, max_items: int, target: float) -> DataFrame:
    """Failed units cut again: packed under the limits or, where that leaves one piece of several rows, halved (the first half larger); column piece."""
    from corpusloom.operators import folds

    packed = folds.fold_units(rows, keys, order, cost, folds.greedy(max_items, target), "_u")
    w = Window.partitionBy(*keys)
    at = packed.withColumns({"_i": F.row_number().over(w.orderBy(*order)), "_n": F.count(F.lit(1)).over(w), "_m": F.max("_u").over(w)})
    half = (F.col("_i") > F.ceil(F.col("_n") / 2)).cast("long")
    return at.withColumn("piece", F.when((F.col("_m") == 0) & (F.col("_n") > 1), half).otherwise(F.col("_u"))).drop("_u", "_i", "_n", "_m")


def cover_issues(items: DataFrame, ranges: DataFrame, coll: str, seq: str) -> DataFrame:
    """(coll, seq, problem) of units (coll, first, last) against the items: 'uncovered', 'covered_twice', or 'no_item' for a place in a unit that no item has.

    Units are packed under limits, so a range is expanded to few places.
    """
    spread = ranges.filter("first <= last").select(coll, F.explode(F.sequence("first", "last")).alias(seq)).groupBy(coll, seq).agg(F.count(F.lit(1)).alias("_c"))
    both = items.select(coll, seq, F.lit(True).alias("_i")).distinct().join(spread, [coll, seq], "full")
    problem = F.when(F.col("_i").isNull(), "no_item").when(F.col("_c").isNull(), "uncovered").when(F.col("_c") > 1, "covered_twice")
    return both.withColumn("problem", problem).filter("problem is not null").select(coll, seq, "problem")


def roll_issues(clips: DataFrame, words: DataFrame, key: str, most: float = 0.5, least: float = 0.2, margin: float = 0.1, tail: str = "render_seconds") -> DataFrame:
    """(key, problem) of clips (key, unit, start, end, pre_roll, post_roll, ``tail``) against the words (unit, start, end) of their unit.

    'pre_roll' (not in 0..``most``, or before the unit begins), 'crosses_previous' (it reaches a word that ended before the clip, or the
    ``margin`` after it), 'post_roll' (under ``least``), 'crosses_next', 'no_closing' (no time left for the last frame).  Of the words of a
    unit only the last end before a clip and the first start after it are kept.
    """
    near = clips.select(key, "unit", F.col("start").alias("_s"), F.col("end").alias("_e")).join(words.select("unit", F.col("start").alias("_ws"), F.col("end").alias("_we")), "unit", "left")
    slack = 0.001
    per = near.groupBy(key).agg(F.max(F.when(F.col("_we") < F.col("_s") - slack, F.col("_we"))).alias("_before"), F.min(F.when(F.col("_ws") > F.col("_e") + slack, F.col("_ws"))).alias("_after"))
    c = clips.join(per, key)
    pre, post, start, end = (F.col(x) for x in ("pre_roll", "post_roll", "start", "end"))
    checks = [
        ("pre_roll", (pre >= 0) & (pre <= most) & (start >= pre)),
        ("crosses_previous", (pre == 0) | F.col("_before").isNull() | (start - pre > F.col("_before") + margin)),
        ("post_roll", post >= least),
        ("crosses_next", F.col("_after").isNull() | (end + post < F.col("_after") - margin)),
        ("no_closing", end - start + pre + post < F.col(tail)),
    ]
    return C.failures(c, [key], checks)


def aligned_words_gate(words: DataFrame, expected: DataFrame, unit: str, whole: float = 0.95, slack: float = 0.002, gap_words: int = 2, gap_seconds: float = 1.0) -> DataFrame:
    """(unit, problem) of timed words (unit, place, text, start_char, end_char, start, end, source, duration) against the expected ones (unit, place, text, start_char, end_char).

    'inventory' (other places), 'offsets' (text or characters differ), 'order' (a word begins before the one before ends), 'bounds',
    'evidence' (a source other than exact, mapped or interpolated), 'interpolation' (times other than the slots between measured words allow)
    and 'coverage' (fewer than ``whole`` measured).
    """
    from corpusloom.operators import timeline

    told = expected.select(unit, "place", F.struct("text", "start_char", "end_char").alias("_x"))
    got = words.withColumn("_w", F.struct("text", "start_char", "end_char"))
    got = got.withColumn("_prev", F.lag("end").over(Window.partitionBy(unit).orderBy("place")))
    measured = F.col("source").isin("exact", "mapped")
    anchors = got.withColumn("_a", F.when(measured, F.col("start"))).withColumn("_b", F.when(measured, F.col("end")))
    slots = timeline.word_slots(anchors.withColumnRenamed("source", "_source"), [unit], "place", "_a", "_b", gap_words, gap_seconds)
    slots = slots.withColumn("_off", ~F.coalesce((F.abs(F.col("start") - F.col("slot_start")) <= slack) & (F.abs(F.col("end") - F.col("slot_end")) <= slack), F.lit(False)))
    both = slots.join(told, [unit, "place"], "full")
    s, e = F.col("start"), F.col("end")
    any_ = lambda c: F.coalesce(F.bool_or(c), F.lit(False))
    here = F.col("_w").isNotNull()
    per = both.groupBy(unit).agg(
        any_(~here | F.col("_x").isNull()).alias("inventory"), any_(here & F.col("_x").isNotNull() & (F.col("_w") != F.col("_x"))).alias("offsets"),
        any_(s < F.coalesce("_prev", F.lit(0.0)) - slack).alias("order"), any_((e <= s) | (e > F.col("duration") + slack)).alias("bounds"),
        any_(~F.col("_source").isin("exact", "mapped", "interpolated")).alias("evidence"), any_(here & F.col("_off")).alias("interpolation"),
        F.coalesce(F.try_divide(F.count_if(F.col("_source").isin("exact", "mapped")), F.count_if(here)) >= whole, F.lit(False)).alias("covered"),
    )
    return C.failures(per, [unit], [(n, ~F.col(n)) for n in ("inventory", "offsets", "order", "bounds", "evidence", "interpolation")] + [("coverage", F.col("covered"))])


#: Pairs of quotation marks.
QUOTE_PAIRS = r'(?s)^\s*(?:"(.*)"|\x{27}(.*)\x{27}|\x{201C}(.*)\x{201D}|\x{2018}(.*)\x{2019}|\x{AB}(.*)\x{BB})\s*$'


def folded_ground(text: Column, alike: dict[str, str]) -> Column:
    """Decomposed, letters of ``alike`` as what they stand for (one character each, or nothing), without marks, white space even."""
    from corpusloom.functions.texts import even_spaces, normal_form

    kept = {a: b for a, b in alike.items() if b}
    swapped = F.translate(normal_form(text, "NFD"), "".join(kept) + "".join(a for a, b in alike.items() if not b), "".join(kept.values()))
    return even_spaces(F.regexp_replace(swapped, r"\p{Mn}", ""))


def grounded_in_order(text: Column, ground: Column, alike: dict[str, str]) -> Column:
    """Whether the parts of a ground, parted by three dots or an ellipsis and freed of one pair of quotes around all, stand in a text in their order, both folded; without a part it does not."""
    bare = F.regexp_replace(ground, QUOTE_PAIRS, "$1$2$3$4$5")
    whole, parts = folded_ground(text, alike), F.split(F.replace(folded_ground(bare, alike), F.lit("\u2026"), F.lit("...")), r"\.\.\.")
    some = F.filter(F.transform(parts, lambda p: F.trim(p)), lambda p: p != "")

    start = F.struct(F.lit(True).alias("ok"), whole.alias("rest"))

    def step(s: Column, part: Column) -> Column:
        found = F.position(part, s["rest"])
        return F.struct((s["ok"] & (found > 0)).alias("ok"), F.substring(s["rest"], found + F.length(part), F.length(s["rest"])).alias("rest"))

    return F.coalesce((F.size(some) > 0) & F.aggregate(some, start, step, lambda s: s["ok"]), F.lit(False))


def severe_verdict(findings: DataFrame, key: str, severe: list[str]) -> DataFrame:
    """(key, problem) of verdicts tied to severe findings only (findings: key, severity, verdict; a null severity is an entry without finding): 'pass_with_severe', 'revise_without_severe', 'unknown_verdict'."""
    per = findings.groupBy(key).agg(F.coalesce(F.bool_or(F.col("severity").isin(severe)), F.lit(False)).alias("_s"), F.max("verdict").alias("_v"))
    problem = F.when(~F.coalesce(F.col("_v").isin("pass", "revise"), F.lit(False)), "unknown_verdict").when((F.col("_v") == "pass") & F.col("_s"), "pass_with_severe").when((F.col("_v") == "revise") & ~F.col("_s"), "revise_without_severe")
    return per.withColumn("problem", problem).filter("problem is not null").select(key, "problem")


def decision_order(targets: DataFrame, decisions: DataFrame, scope: str, key: str) -> DataFrame:
    """(scope, key, problem): decisions (scope, key, place) that are not in the order of their targets (scope, key, place) inside the scope: 'order'."""
    w = lambda c: F.row_number().over(Window.partitionBy(scope).orderBy(c))  # noqa: E731  the targets of one batch
    both = decisions.select(scope, key, F.col("place").alias("_d")).join(targets.select(scope, key, F.col("place").alias("_t")), [scope, key])
    ranked = both.withColumns({"_a": w("_d"), "_b": w("_t")})
    return ranked.filter("_a <> _b").select(scope, key, F.lit("order").alias("problem"))


def media_drift(df: DataFrame, keys: list[str], size: str, probed_size: str, seconds: str, probed_seconds: str) -> DataFrame:
    """(keys, problem) of recorded against probed sizes (over 4096 bytes and 2 %) and durations (over 1.5 s and, up to 30 s, 0.05 %); an unknown value is a problem too."""
    apart = lambda a, b: F.abs(F.col(a) - F.col(b))
    checks = [
        ("size", apart(size, probed_size) <= F.greatest(F.lit(4096.0), F.col(size) * 0.02)),
        ("duration", apart(seconds, probed_seconds) <= F.greatest(F.lit(1.5), F.least(F.lit(30.0), F.col(seconds) * 0.0005))),
    ]
    return C.failures(df, keys, checks)


def timing_issues(df: DataFrame, key: str, latest_hook: float = 2, closing: float = 1) -> DataFrame:
    """(key, problem) of a clip's hook, quote, quote_end and ends: 'late_hook', 'quote_before_hook', 'empty_quote', 'no_closing'."""
    hook, quote, end = F.col("hook"), F.col("quote"), F.col("quote_end")
    return C.failures(df, [key], [("late_hook", hook <= latest_hook), ("quote_before_hook", quote >= hook), ("empty_quote", end > quote), ("no_closing", F.col("ends") - end >= closing)])


def plausible_rate(amount: Column, per: Column, low: float, high: float) -> tuple[Column, Column]:
    """(ratio, whether it lies between ``low`` and ``high``); without a ratio it does not."""
    ratio = F.try_divide(amount, per)
    return ratio, F.coalesce(ratio.between(low, high), F.lit(False))


def buffer_inventory(df: DataFrame, keys: list[str], ready: Column, target: int) -> DataFrame:
    """(keys, ready, blocked, shortfall): how many are ready, how many are not, and how many are lacking to the target."""
    ok = F.coalesce(ready, F.lit(False))
    per = df.groupBy(*keys).agg(F.count_if(ok).alias("ready"), F.count_if(~ok).alias("blocked"))
    return per.withColumn("shortfall", F.greatest(F.lit(0).cast("long"), F.lit(target) - F.col("ready")))
