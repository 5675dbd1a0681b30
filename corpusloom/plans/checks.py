"""Queries of rule tables, exact covers, rolls, timed words and grounds."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from corpusloom.operators import gates as G
from corpusloom.operators import rules as R
from corpusloom.plans.base import ITEMS, items, query

RUN = r"[\p{L}\p{M}\p{N}_]+"

#: code, kind, what, severity, required; signs have no meaning in terms and literals.
RULES = [("insult", "term", "idiot", "error", False), ("insult", "term", "MORON", "error", False), ("common", "term", "of the", "note", False), ("mark", "literal", " | ", "warning", False), ("lead", "literal", "The ", "note", False), ("dots", "literal", "a.b", "note", False), ("paren", "pattern", r"\([^)]*\)", "warning", False), ("letter", "pattern", "[a-z]", "error", True)]
KEYED = "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'the' ELSE 'and' END AS what, doc_id % 2 = 0 AS required FROM labels"


@query("prj6_rule_table", rf"""WITH w AS (SELECT doc_id, text, ' ' || array_to_string(regexp_extract_all(lower(text), '{RUN}'), ' ') || ' ' AS l FROM documents), k AS ({KEYED})
SELECT doc_id, 'insult' AS code, 'error' AS severity, what FROM w, (VALUES ('idiot'), ('MORON')) t(what) WHERE contains(l, ' ' || lower(what) || ' ')
UNION ALL SELECT doc_id, 'common', 'note', 'of the' FROM w WHERE regexp_matches(lower(text), '(^|[^\p{{L}}\p{{M}}\p{{N}}_])of the($|[^\p{{L}}\p{{M}}\p{{N}}_])')
UNION ALL SELECT doc_id, 'mark', 'warning', ' | ' FROM w WHERE contains(text, ' | ') UNION ALL SELECT doc_id, 'lead', 'note', 'The ' FROM w WHERE contains(text, 'The ') UNION ALL SELECT doc_id, 'dots', 'note', 'a.b' FROM w WHERE contains(text, 'a.b')
UNION ALL SELECT doc_id, 'paren', 'warning', '\([^)]*\)' FROM w WHERE regexp_matches(text, '\([^)]*\)') UNION ALL SELECT doc_id, 'letter', 'error', '[a-z]' FROM documents WHERE NOT regexp_matches(coalesce(text, ''), '[a-z]')
UNION ALL SELECT doc_id, 'keyed', 'error', what FROM k JOIN documents USING (doc_id) WHERE contains(coalesce(text, ''), what) <> required""")
def rule_table(read):
    d = read("documents").select("doc_id", "text")
    wide = d.sparkSession.createDataFrame([(c, k, w, s, None, r) for c, k, w, s, r in RULES], R.RULE_TABLE)
    k = F.col("doc_id")
    own = read("labels").select(F.lit("keyed").alias("code"), F.lit("literal").alias("kind"), F.when(k % 3 == 0, "the").otherwise("and").alias("what"), F.lit("error").alias("severity"), k.cast("string").alias("key"), (k % 2 == 0).alias("required"))
    return R.table_issues(d, wide.unionByName(own), "doc_id", "text")


@query("gat8_exact_cover", f"""WITH {ITEMS}, u AS (SELECT coll, min(seq) AS a, max(seq) + CASE WHEN coll % 5 = 0 THEN 1 ELSE 0 END AS b FROM items WHERE NOT (coll % 7 = 0 AND seq <= 3) GROUP BY coll, (seq - 1) // 3), e AS (SELECT coll, unnest(range(a, b + 1)) AS seq FROM u), c AS (SELECT coll, seq, count(*) AS n FROM e GROUP BY ALL)
SELECT coalesce(i.coll, c.coll) AS coll, coalesce(i.seq, c.seq) AS seq, CASE WHEN i.coll IS NULL THEN 'no_item' WHEN n IS NULL THEN 'uncovered' ELSE 'covered_twice' END AS problem FROM items i FULL JOIN c ON c.coll = i.coll AND c.seq = i.seq WHERE i.coll IS NULL OR n IS NULL OR n > 1""")
def exact_cover(read):
    it = items(read).select("coll", "seq")
    units = it.filter("not (coll % 7 = 0 and seq <= 3)").groupBy("coll", F.floor((F.col("seq") - 1) / 3).alias("unit")).agg(F.min("seq").alias("first"), (F.max("seq") + F.when(F.first("coll") % 5 == 0, 1).otherwise(0)).alias("last"))
    return G.cover_issues(it, units, "coll", "seq")


@query("gat13_roll_gate", """WITH w AS (SELECT user_id AS unit, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events), t AS (SELECT unit, event_id, p, p * 10 AS s, p * 10 + 5 + event_id % 4 AS e FROM w),
c AS (SELECT event_id, unit, p, s, e, event_id % 7 AS pre, event_id % 5 AS post, e - s + 2 + event_id % 3 * 4 AS len FROM t WHERE p % 5 = 3),
n AS (SELECT c.event_id, any_value(c.s) AS s, any_value(c.e) AS e, any_value(pre) AS pre, any_value(post) AS post, any_value(len) AS len, max(t.e) FILTER (t.e < c.s) AS b, min(t.s) FILTER (t.s > c.e) AS a FROM c JOIN t ON t.unit = c.unit GROUP BY c.event_id)
SELECT event_id, unnest(list_filter([CASE WHEN NOT (pre <= 5 AND s >= pre) THEN 'pre_roll' END, CASE WHEN pre > 0 AND b IS NOT NULL AND s - pre <= b + 1 THEN 'crosses_previous' END, CASE WHEN post < 2 THEN 'post_roll' END, CASE WHEN a IS NOT NULL AND e + post >= a - 1 THEN 'crosses_next' END, CASE WHEN e - s + pre + post >= len THEN 'no_closing' END], lambda x: x IS NOT NULL)) AS problem FROM n""")
def roll_gate(read):
    """Times in tenths of seconds, as whole numbers are the same in both engines."""
    k = F.col("event_id")
    place = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    t = read("events").select(F.col("user_id").alias("unit"), k, place.alias("p")).withColumn("start", F.col("p") * 10).withColumn("end", F.col("p") * 10 + 5 + k % 4)
    clips = t.filter("p % 5 = 3").select(k, "unit", "start", "end", (k % 7).alias("pre_roll"), (k % 5).alias("post_roll"), (F.col("end") - F.col("start") + 2 + k % 3 * 4).alias("render_seconds"))
    return G.roll_issues(clips, t.select("unit", "start", "end"), "event_id", most=5, least=2, margin=1)


#: Words of a turn with their characters; times from the place, some interpolated, some wrong.
TIMED = f"""{ITEMS}, x AS (SELECT ref, coll, string_split(text, ' ') AS w FROM items), o AS (SELECT ref, coll, unnest(range(0, len(w))) AS place, unnest(w) AS text, len(w) AS n FROM x),
e AS (SELECT ref, coll, n, place, text, sum(length(text) + 1) OVER (PARTITION BY ref ORDER BY place) - length(text) - 1 AS a FROM o),
g AS (SELECT *, CASE WHEN coll % 6 = 1 AND place = 4 THEN 'guess' WHEN place % 29 = 7 AND place < n - 1 THEN 'interpolated' ELSE 'exact' END AS source FROM e)"""


@query("gat7_timed_words", f"""WITH {TIMED} SELECT ref, unnest(list_filter([CASE WHEN coll % 9 = 2 THEN 'inventory' END, CASE WHEN coll % 9 <> 2 AND coll % 7 = 3 OR coll % 9 = 2 AND coll % 7 = 3 AND n > 1 THEN 'offsets' END, CASE WHEN coll % 6 = 1 AND n > 4 THEN 'evidence' END,
 CASE WHEN bad_slot THEN 'interpolation' END, CASE WHEN shown = 0 OR measured < 0.95 * shown THEN 'coverage' END], lambda x: x IS NOT NULL)) AS problem
 FROM (SELECT ref, coll, n, bool_or(place < n - (coll % 9 = 2)::INT AND (source = 'guess' OR source = 'interpolated' AND (coll % 5 = 0 OR place = n - (coll % 9 = 2)::INT - 1))) AS bad_slot,
  count(*) FILTER (source = 'exact' AND place < n - (coll % 9 = 2)::INT) AS measured, count(*) FILTER (place < n - (coll % 9 = 2)::INT) AS shown FROM g GROUP BY ref, coll, n)""")
def timed_words(read):
    words = items(read).select("ref", "coll", F.split("text", " ").alias("w"))
    each = words.select("ref", "coll", F.size("w").alias("n"), F.posexplode("w").alias("place", "text"))
    along = Window.partitionBy("ref").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    start = F.sum(F.length("text") + 1).over(along) - F.length("text") - 1
    expected = each.withColumn("start_char", start).withColumn("end_char", F.col("start_char") + F.length("text"))
    c, p = F.col("coll"), F.col("place")
    source = F.when((c % 6 == 1) & (p == 4), "guess").when((p % 29 == 7) & (p < F.col("n") - 1), "interpolated").otherwise("exact")
    own = F.when(source == "interpolated", F.when(c % 5 == 0, p * 0.5 + 0.2).otherwise(p * 0.5 - 0.1)).otherwise(p * 0.5)
    timed = expected.withColumn("source", source).withColumn("start", own).withColumn("end", F.when((source == "interpolated") & (c % 5 != 0), p * 0.5 + 0.5).otherwise(F.when(source == "interpolated", own + 0.25).otherwise(own + 0.4)))
    timed = timed.withColumn("end_char", F.when((c % 7 == 3) & (p == 0), F.col("end_char") + 1).otherwise(F.col("end_char"))).withColumn("duration", F.lit(1e6))
    return G.aligned_words_gate(timed.filter(~((c % 9 == 2) & (p == F.col("n") - 1))), expected, "ref")


GROUND = "CASE doc_id % 6 WHEN 0 THEN substr(text, 1, 9) || '...' || substr(text, 30, 9) WHEN 1 THEN chr(171) || substr(text, 5, 12) || chr(187) WHEN 2 THEN substr(text, 30, 9) || chr(8230) || substr(text, 1, 9) WHEN 3 THEN strip_accents(substr(text, 3, 15)) WHEN 4 THEN '...' ELSE 'zz' || substr(text, 1, 5) END"


@query("con3_folded_grounds", rf"""WITH g AS (SELECT doc_id, text, {GROUND} AS ground FROM documents WHERE text IS NOT NULL), f AS (SELECT doc_id, trim(regexp_replace(strip_accents(text), '[\s\x0B\x{{85}}\p{{Z}}\x1C-\x1F]+', ' ', 'g')) AS t, list_filter(list_transform(regexp_split_to_array(replace(trim(regexp_replace(strip_accents(CASE WHEN doc_id % 6 = 1 THEN substr(ground, 2, length(ground) - 2) ELSE ground END), '[\s\x0B\x{{85}}\p{{Z}}\x1C-\x1F]+', ' ', 'g')), chr(8230), '...'), '\.\.\.'), lambda p: trim(p)), lambda p: p <> '') AS parts FROM g)
SELECT doc_id, CASE WHEN len(parts) = 0 THEN false WHEN strpos(t, parts[1]) = 0 THEN false WHEN len(parts) = 1 THEN true ELSE contains(substr(t, strpos(t, parts[1]) + length(parts[1])), parts[2]) END AS grounded FROM f WHERE len(parts) < 3""")
def folded_grounds(read):
    """Parts in order, out of order, in quotes, without their accents, and none; grounds that dots of their own cut further are left out of the comparison."""
    from corpusloom.functions.texts import without_marks

    k, t = F.col("doc_id") % 6, F.col("text")
    ground = (
        F.when(k == 0, F.concat(F.substring(t, 1, 9), F.lit("..."), F.substring(t, 30, 9)))
        .when(k == 1, F.concat(F.lit("«"), F.substring(t, 5, 12), F.lit("»")))
        .when(k == 2, F.concat(F.substring(t, 30, 9), F.lit("…"), F.substring(t, 1, 9)))
        .when(k == 3, without_marks(F.substring(t, 3, 15)))
        .when(k == 4, "...")
        .otherwise(F.concat(F.lit("zz"), F.substring(t, 1, 5)))
    )
    d = read("documents").filter("text is not null").withColumn("g", ground)
    parts = F.size(F.filter(F.split(F.replace("g", F.lit("…"), F.lit("...")), r"\.\.\."), lambda p: F.trim(F.regexp_replace(p, r"[\s\p{Z}]+", " ")) != ""))
    return d.filter(parts < 3).select("doc_id", G.grounded_in_order(t, F.col("g"), {}).alias("grounded"))


@query("con3_severe_verdicts", "WITH f AS (SELECT doc_id // 4 AS unit, CASE WHEN toxic = 1 THEN 'blocking' WHEN quality = 0 THEN 'minor' END AS severity FROM labels), v AS (SELECT unit, coalesce(bool_or(severity = 'blocking'), false) AS s, CASE unit % 4 WHEN 0 THEN 'pass' WHEN 3 THEN 'maybe' ELSE 'revise' END AS verdict FROM f GROUP BY unit) SELECT unit, CASE WHEN verdict = 'maybe' THEN 'unknown_verdict' WHEN s THEN 'pass_with_severe' ELSE 'revise_without_severe' END AS problem FROM v WHERE verdict = 'maybe' OR verdict = 'pass' AND s OR verdict = 'revise' AND NOT s")
def severe_verdicts(read):
    unit = F.floor(F.col("doc_id") / 4)
    f = read("labels").select(unit.alias("unit"), F.when(F.col("toxic") == 1, "blocking").when(F.col("quality") == 0, "minor").alias("severity"))
    verdict = F.when(F.col("unit") % 4 == 0, "pass").when(F.col("unit") % 4 == 3, "maybe").otherwise("revise")
    return G.severe_verdict(f.withColumn("verdict", verdict), "unit", ["blocking"])


@query("con8_decision_order", "WITH t AS (SELECT doc_id, source, doc_id AS p FROM documents), d AS (SELECT doc_id, source, CASE WHEN doc_id % 50 = 7 THEN doc_id + 200 ELSE doc_id END AS p FROM documents WHERE doc_id % 3 <> 0), r AS (SELECT d.source, d.doc_id, row_number() OVER (PARTITION BY d.source ORDER BY d.p, d.doc_id) AS a, row_number() OVER (PARTITION BY d.source ORDER BY t.p) AS b FROM d JOIN t USING (doc_id)) SELECT source, doc_id, 'order' AS problem FROM r WHERE a <> b")
def decision_order(read):
    d = read("documents").select("source", "doc_id")
    k = F.col("doc_id")
    places = F.when(k % 50 == 7, F.struct((k + 200).alias("p"), k.alias("k"))).otherwise(F.struct(k.alias("p"), k.alias("k")))
    return G.decision_order(d.withColumn("place", k), d.filter("doc_id % 3 <> 0").withColumn("place", places), "source", "doc_id")


@query("gat5_term_rules", f"WITH k AS ({KEYED}), p AS (SELECT doc_id, text FROM documents WHERE doc_id % 13 <> 0) SELECT doc_id, CASE WHEN required THEN 'term_missing' ELSE 'term_forbidden' END AS code, what FROM k JOIN p USING (doc_id) WHERE contains(coalesce(text, ''), what) <> required")
def term_rules(read):
    """The part of the second-language gate that holds one text to terms of its own reference."""
    k = F.col("doc_id")
    layer = read("documents").filter("doc_id % 13 <> 0").select("doc_id", "text")
    own = read("labels").select(F.when(k % 2 == 0, "term_missing").otherwise("term_forbidden").alias("code"), F.lit("literal").alias("kind"), F.when(k % 3 == 0, "the").otherwise("and").alias("what"), F.lit("error").alias("severity"), k.cast("string").alias("key"), (k % 2 == 0).alias("required"))
    return R.table_issues(layer, own, "doc_id", "text").select("doc_id", "code", "what")
