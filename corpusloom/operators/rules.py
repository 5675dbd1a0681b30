"""Row-local text rules: detectors, rewrites, classifiers and bands, all as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Word edges in texts of any language; what \b takes for a letter depends on the Java release.
WORD_EDGES = (r"(?<![\p{L}\p{M}\p{N}_])", r"(?![\p{L}\p{M}\p{N}_])")


def quoted(literal: str) -> str:
    """A pattern for the text as it stands, whatever signs are in it."""
    return "".join(f"\\x{{{ord(c):x}}}" if not (c.isalnum() or c.isspace()) else c for c in literal)


def replacement(literal: str) -> str:
    """The text as a replacement, its signs without meaning."""
    return literal.replace("\\", "\\\\").replace("$", "\\$")


def banned_terms(text: Column, terms: list[str], edges: tuple[str, str] = (r"\b", r"\b")) -> Column:
    """Distinct banned whole words found, lower-cased, sorted, comma-joined; empty if none."""
    pattern = rf"(?i){edges[0]}(" + "|".join(map(quoted, sorted(terms, key=len, reverse=True))) + rf"){edges[1]}"
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
    return F.array_join(F.array_sort(F.array_distinct(F.transform(found, F.lower))), ",")


def rule_issues(df: DataFrame, key: str, text: str, rules: dict[str, tuple[str, str]]) -> DataFrame:
    """(key, code, severity): one row per rule (code: regular expression, severity) that a text breaks; one projection for all rules."""
    hits = [F.when(F.col(text).rlike(p), F.struct(F.lit(code).alias("code"), F.lit(sev).alias("severity"))) for code, (p, sev) in rules.items()]
    return df.select(key, F.explode(F.array_compact(F.array(*hits))).alias("i")).select(key, "i.code", "i.severity")


def keyed_term_rules(df: DataFrame, rules: DataFrame, key: str, text: str) -> DataFrame:
    """Rules (key, kind 'required' or 'forbidden', term) against the text of their own key: rows of broken rules."""
    broken = F.when(F.col("kind") == "required", ~F.contains(F.col(text), F.col("term"))).otherwise(F.contains(F.col(text), F.col("term")))
    return df.join(rules, key).filter(broken).select(key, "kind", "term")


def phrase_leads(df: DataFrame, key: str, text: str, phrases: list[str]) -> DataFrame:
    """(key, phrase, found): the original-case slice of the first case-insensitive occurrence."""
    found = lambda p: F.regexp_extract(F.col(text), rf"(?iu)\Q{p}\E", 0)  # in the text itself: lower-casing can move places
    leads = [F.when(found(p) != "", F.struct(F.lit(p).alias("phrase"), found(p).alias("found"))) for p in phrases]
    return df.select(key, F.explode(F.array_compact(F.array(*leads))).alias("l")).select(key, "l.*")


def rewrite(text: Column, steps: list[tuple[str, str, str]], edges: tuple[str, str] = (r"\b", r"\b")) -> tuple[Column, Column]:
    """Whole-word replacements that keep UPPER and Title case; steps: (label, word, replacement).

    Returns the new text and the array of ``label: count`` of the steps that changed something.
    """
    edits, (left, right) = [], edges
    for label, old, new in steps:
        n = F.regexp_count(text, F.lit(rf"(?iu){left}{quoted(old)}{right}"))
        edits.append(F.when(n > 0, F.concat(F.lit(f"{label}: "), n.cast("string"))))
        for a, b in ((old.upper(), new.upper()), (old.capitalize(), new.capitalize())):
            text = F.regexp_replace(text, rf"{left}{quoted(a)}{right}", replacement(b))
        text = F.regexp_replace(text, rf"(?iu){left}{quoted(old)}{right}", replacement(new))
    return text, F.array_compact(F.array(*edits))


def script_check(text: Column, required: str, forbidden: str) -> Column:
    """'ok', 'missing_script' or 'forbidden_script' by character classes."""
    return F.when(~text.rlike(required), "missing_script").when(text.rlike(forbidden), "forbidden_script").otherwise("ok")


def classify(message: Column, rules: list[tuple[str, list[str]]], default: str) -> Column:
    """The first class of which a marker occurs in the message, any case."""
    low = F.lower(message)
    out = None
    for name, markers in rules:
        hit = reduce(lambda a, b: a | b, [F.contains(low, F.lit(m)) for m in markers])
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise(default)


def band(value: Column, limits: list[tuple[float, str]], beyond: str) -> Column:
    out = None
    for limit, name in limits:
        out = F.when(value <= limit, name) if out is None else out.when(value <= limit, name)
    return out.otherwise(beyond)


def age_window(hours: Column, windows: list[tuple[float, float]]) -> Column:
    """The first window (centre, tolerance) that the age falls into, as its centre; null otherwise."""
    out = F.lit(None).cast("long")
    for centre, tolerance in reversed(windows):
        out = F.when(F.abs(hours - centre) <= tolerance, F.lit(int(centre)).cast("long")).otherwise(out)
    return out


def per_mille(a: Column, b: Column) -> Column:
    """a / b * 1000 to three digits; null where either is unknown or b is 0."""
    return F.round(F.try_divide(a, b) * 1000, 3)


def occurrences(text: Column, piece: Column) -> Column:
    """How often ``piece`` occurs in ``text`` without overlap."""
    return F.when(F.length(piece) > 0, ((F.length(text) - F.length(F.replace(text, piece, F.lit("")))) / F.length(piece)).cast("long"))


#: Rows of a rule table: kind 'term' (a whole word or words, any case), 'literal' (as it stands), 'pattern' (a regular
#: expression), each banned or, with ``required``, missed; a null ``key`` is for every text, another for the text of that key.
RULE_TABLE = "code string, kind string, what string, severity string, key string, required boolean"
TERM_WORD = r"[\p{L}\p{M}\p{N}_]+"
MOST_PATTERNS = 1000


def table_issues(texts: DataFrame, rules: DataFrame, key: str, text: str) -> DataFrame:
    """(key, code, severity, what): rules of a table (RULE_TABLE) that the texts break.

    Terms and literals for every text are found through their first word: texts are cut into distinct words once, those that start some
    rule's words are joined with the rules, and the rule is then confirmed on the text, so the number of terms does not matter and no pattern is made of them.
    A literal that does not begin at a word is looked for like a pattern.  Patterns for every text are applied in one projection and so
    are few (MOST_PATTERNS at most, else an error).  Rules of one text are joined with it.
    Null texts break required rules only.
    """
    rows = texts.select(F.col(key).cast("string").alias("_key"), F.col(key), F.col(text).alias("_t"))
    parts = rules.withColumn("_id", F.xxhash64(*rules.columns)).withColumn("_w", F.regexp_extract_all(F.lower("what"), F.lit(TERM_WORD), F.lit(0)))
    starts = F.col("what").rlike(r"^[\p{L}\p{M}\p{N}_]")
    wide = F.col("key").isNull()
    worded = wide & (F.size("_w") > 0) & ((F.col("kind") == "term") | ((F.col("kind") == "literal") & starts))
    own = parts.filter(~wide).select("code", "kind", "what", "severity", F.col("key").alias("_key"), "required")
    out = rows.join(own, "_key").filter(_broken()).select(key, "code", "severity", "what")

    indexed = parts.filter(worded & ~F.coalesce("required", F.lit(False))).select("code", "kind", "what", "severity", "required", F.col("_w")[0].alias("_first"))
    words = rows.select("_key", key, "_t", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("_t"), F.lit(TERM_WORD), F.lit(0)))).alias("_first"))
    hit = words.select("_key", key, "_first").join(indexed, "_first").join(rows.select("_key", "_t"), "_key").filter(_broken())
    out = out.unionByName(hit.select(key, "code", "severity", "what").distinct())

    few = parts.filter(wide & ~(worded & ~F.coalesce("required", F.lit(False)))).select("code", "kind", "what", "severity", F.coalesce("required", F.lit(False)).alias("required")).limit(MOST_PATTERNS + 1).collect()
    if len(few) > MOST_PATTERNS:
        raise ValueError(f"more than {MOST_PATTERNS} patterns for every text")
    told = [F.when(_breaks(F.col("_t"), r["kind"], r["what"], r["required"]), F.struct(F.lit(r["code"]).alias("code"), F.lit(r["severity"]).alias("severity"), F.lit(r["what"]).alias("what"))) for r in few]
    if told:
        found = rows.select(key, F.explode(F.array_compact(F.array(*told))).alias("i")).select(key, "i.code", "i.severity", "i.what")
        out = out.unionByName(found)
    return out


def _breaks(text: Column, kind: str, what: str, required: bool) -> Column:
    pattern = {"term": rf"(?iu){WORD_EDGES[0]}{quoted(what)}{WORD_EDGES[1]}", "pattern": what}.get(kind)
    there = F.coalesce(F.contains(text, F.lit(what)) if pattern is None else text.rlike(pattern), F.lit(False))
    return ~there if required else there


def _broken() -> Column:
    """Whether the rule of a joined row (kind, what, required) is broken by its text ``_t``."""
    sign = F.regexp_replace("what", r"([^\p{L}\p{M}\p{N}_\s])", r"\\$1")
    term = F.rlike("_t", F.concat(F.lit(f"(?iu){WORD_EDGES[0]}"), sign, F.lit(WORD_EDGES[1])))
    there = F.when(F.col("kind") == "term", term).when(F.col("kind") == "literal", F.contains("_t", F.col("what"))).otherwise(F.rlike("_t", F.col("what")))
    there = F.coalesce(there, F.lit(False))
    return F.when(F.coalesce("required", F.lit(False)), ~there).otherwise(there)
