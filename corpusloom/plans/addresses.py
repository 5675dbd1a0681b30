"""Queries on addresses, ranges, context, sections and coverage."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from corpusloom.operators import address as A
from corpusloom.plans.base import ITEMS, items, query


@query("prj1_parse_ref", f"WITH {ITEMS} SELECT ref, CASE WHEN regexp_matches(ref, '^[0-9]{{1,3}}:[0-9]{{1,3}}$') THEN split_part(ref, ':', 1)::BIGINT END AS coll, CASE WHEN regexp_matches(ref, '^[0-9]{{1,3}}:[0-9]{{1,3}}$') THEN split_part(ref, ':', 2)::BIGINT END AS seq FROM items")
def parse_ref(read):
    return items(read).select("ref", A.parse_ref(F.col("ref")).alias("r")).select("ref", "r.coll", "r.seq")


@query("prj2_ref_in_range", f"WITH {ITEMS} SELECT ref FROM items WHERE coll * 1000 + seq BETWEEN 5002 AND 40003")
def in_range(read):
    return items(read).filter(A.in_range(F.col("coll"), F.col("seq"), (5, 2), (40, 3))).select("ref")


@query("prj3_expand_range", "SELECT o_custkey, o_orderkey * 10 + s AS ref FROM (SELECT o_custkey, o_orderkey, unnest(range(1, o_orderkey % 4 + 2)) AS s FROM orders)")
def expand_range(read):
    spans = read("orders").select("o_custkey", "o_orderkey", F.lit(1).cast("long").alias("a"), (F.col("o_orderkey") % 4 + 1).alias("b"))
    return A.expand_range(spans, "a", "b").select("o_custkey", (F.col("o_orderkey") * 10 + F.col("seq")).alias("ref"))


@query("prj4_range_label", f"""WITH {ITEMS}, l AS (SELECT coll, seq, lead(coll, 2) OVER (ORDER BY coll, seq) AS c2, lead(seq, 2) OVER (ORDER BY coll, seq) AS s2 FROM items WHERE coll % 10 = 3 OR seq = 1)
SELECT coll, max(seq) AS last_seq, CASE WHEN max(seq) = 1 THEN 'Part ' || coll || ':1' ELSE 'Part ' || coll || ':1-' || max(seq) END AS label FROM items GROUP BY coll""")
def range_label(read):
    spans = items(read).groupBy("coll").agg(F.max("seq").alias("last_seq"))
    one = F.lit(1).cast("long")
    return spans.select("coll", "last_seq", A.range_label(F.col("coll"), one, F.col("coll"), F.col("last_seq"), "Part").alias("label"))


@query("jon1_coverage_diff", f"""WITH {ITEMS}, a AS (SELECT coll, seq FROM items WHERE (coll + seq) % 11 <> 0 UNION ALL SELECT coll, max(seq) + 1 FROM items WHERE coll % 9 = 0 GROUP BY coll)
SELECT coll, seq, 'missing' AS problem FROM items WHERE (coll, seq) NOT IN (SELECT (coll, seq) FROM a) UNION ALL SELECT coll, seq, 'unexpected' FROM a WHERE (coll, seq) NOT IN (SELECT (coll, seq) FROM items)""")
def coverage_diff(read):
    it = items(read).select("coll", "seq")
    extra = it.filter(F.col("coll") % 9 == 0).groupBy("coll").agg((F.max("seq") + 1).alias("seq"))
    return A.coverage_diff(it, it.filter((F.col("coll") + F.col("seq")) % 11 != 0).unionByName(extra), ["coll", "seq"])


@query("jon2_missing_text", f"WITH {ITEMS} SELECT ref FROM items WHERE (coll * 7 + seq) % 13 = 0 ORDER BY coll, seq LIMIT 100")
def missing_text(read):
    it = items(read)
    texts = it.filter((F.col("coll") * 7 + F.col("seq")) % 13 != 0).select("ref")
    return it.join(texts, "ref", "left_anti").orderBy("coll", "seq").limit(100).select("ref")


UNITS = "units AS (SELECT coll, (seq - 1) // 3 AS unit, min(seq) AS a, max(seq) AS b FROM items GROUP BY ALL)"


def _units(read):
    it = items(read).withColumn("unit", F.floor((F.col("seq") - 1) / 3))
    u = it.groupBy("coll", "unit").agg(F.min("seq").alias("first"), F.max("seq").alias("last"))
    return u.withColumn("unit_id", F.concat("coll", F.lit("-"), "unit"))


@query("jon3_neighbour_context", f"""WITH {ITEMS}, {UNITS} SELECT units.coll || '-' || unit AS unit_id, ref, CASE WHEN seq < a THEN 'before' WHEN seq > b THEN 'after' ELSE 'own' END AS place
FROM units JOIN items ON items.coll = units.coll AND seq BETWEEN a - 2 AND b + 1""")
def neighbour_context(read):
    return A.neighbour_context(_units(read), items(read).select("coll", "seq", "ref"), 2, 1).select("unit_id", "ref", "place")


@query("jon5_unit_context_text", f"""WITH {ITEMS}, {UNITS}, t AS (SELECT items.coll, unit, string_agg(text, ' ' ORDER BY seq) AS body FROM items JOIN units ON items.coll = units.coll AND seq BETWEEN a AND b GROUP BY ALL)
SELECT coll, unit::BIGINT AS unit, right(lag(body) OVER w, 40) AS before_text, left(lead(body) OVER w, 30) AS after_text FROM t WINDOW w AS (PARTITION BY coll ORDER BY unit)""")
def unit_context_text(read):
    it = items(read).withColumn("unit", F.floor((F.col("seq") - 1) / 3))
    pieces = F.array_sort(F.collect_list(F.struct("seq", "text")))
    body = it.groupBy("coll", "unit").agg(F.array_join(F.transform(pieces, lambda p: p["text"]), " ").alias("body"))
    w = Window.partitionBy("coll").orderBy("unit")
    return body.select("coll", "unit", F.right(F.lag("body").over(w), F.lit(40)).alias("before_text"), F.left(F.lead("body").over(w), F.lit(30)).alias("after_text"))


@query("jon4_section_assignment", "WITH s AS (SELECT DISTINCT doc_id // 37 AS section FROM documents) SELECT doc_id, section FROM documents JOIN s ON doc_id BETWEEN section * 37 AND section * 37 + 36")
def section_assignment(read):
    docs = read("documents").select("doc_id")
    sections = docs.select(F.floor(F.col("doc_id") / 37).alias("section")).distinct()
    # the sections are contiguous, so the range join is an equi-join on the section's own bucket
    return docs.withColumn("section", F.floor(F.col("doc_id") / 37)).join(sections, "section").select("doc_id", "section")


@query("jon4_section_check", """WITH s AS (SELECT doc_id // 37 AS section, min(doc_id) + 1 AS a, max(doc_id) + 1 AS b FROM documents GROUP BY ALL)
SELECT section, (a - coalesce(lag(b) OVER (ORDER BY section), 0) - 1)::BIGINT AS gap, (b - a + 1)::BIGINT AS size, greatest(0, b - (SELECT count(*) FROM documents))::BIGINT AS beyond FROM s""")
def section_check(read):
    docs = read("documents")
    s = docs.groupBy(F.floor(F.col("doc_id") / 37).alias("section")).agg((F.min("doc_id") + 1).alias("first"), (F.max("doc_id") + 1).alias("last"))
    return A.section_check(s, docs.count()).select("section", "gap", "size", F.col("beyond").cast("long").alias("beyond"))


@query("agg4_collection_cardinality", f"WITH {ITEMS} SELECT coll, count(*) AS n, min(seq) AS first, max(seq) AS last, count(DISTINCT seq) AS distinct_n, min(seq) = 1 AND max(seq) = count(*) AND count(DISTINCT seq) = count(*) AS dense FROM items GROUP BY coll")
def cardinality(read):
    return A.dense_check(items(read), "coll", "seq")


@query("jon10_passage_text", f"""WITH {ITEMS} SELECT coll, string_agg(text, ' ' ORDER BY seq) AS passage, count(*) AS n FROM items WHERE seq BETWEEN 1 AND 3 GROUP BY coll""")
def passage_text(read):
    it = items(read)
    wanted = A.expand_range(it.select("coll").distinct().withColumns({"a": F.lit(1).cast("long"), "b": F.lit(3).cast("long")}), "a", "b").select("coll", "seq")
    pieces = F.array_sort(F.collect_list(F.struct("seq", "text")))
    return it.join(wanted, ["coll", "seq"]).groupBy("coll").agg(F.array_join(F.transform(pieces, lambda p: p["text"]), " ").alias("passage"), F.count(F.lit(1)).alias("n"))


@query("jon14_used_ref_exclusion", f"""WITH {ITEMS}, c AS (SELECT coll, (seq - 1) // 2 AS k, min(seq) AS a, max(seq) AS b FROM items GROUP BY ALL), used AS (SELECT coll, seq FROM items WHERE (coll + seq) % 5 = 0)
SELECT coll, k::BIGINT AS k FROM c WHERE NOT EXISTS (SELECT 1 FROM used WHERE used.coll = c.coll AND seq BETWEEN a AND b)""")
def used_ref_exclusion(read):
    it = items(read).select("coll", "seq")
    cands = it.withColumn("k", F.floor((F.col("seq") - 1) / 2))
    used = it.filter((F.col("coll") + F.col("seq")) % 5 == 0)
    taken = cands.join(used, ["coll", "seq"], "left_semi").select("coll", "k").distinct()
    return cands.select("coll", "k").distinct().join(taken, ["coll", "k"], "left_anti")


@query("set6_exact_cover", f"""WITH {ITEMS}, {UNITS}, e AS (SELECT coll, unnest(range(a, b + 1)) AS seq FROM units)
SELECT items.coll, count(*) AS n, bool_and(c = 1) AS covered_once FROM items LEFT JOIN (SELECT coll, seq, count(*) AS c FROM e GROUP BY ALL) x ON x.coll = items.coll AND x.seq = items.seq GROUP BY items.coll""")
def exact_cover(read):
    spread = A.expand_range(_units(read), "first", "last").groupBy("coll", "seq").agg(F.count(F.lit(1)).alias("c"))
    joined = items(read).join(spread, ["coll", "seq"], "left")
    return joined.groupBy("coll").agg(F.count(F.lit(1)).alias("n"), F.bool_and(F.coalesce(F.col("c") == 1, F.lit(False))).alias("covered_once"))


@query("src5_items_with_texts", f"WITH {ITEMS} SELECT ref, CASE WHEN (coll + seq) % 4 <> 0 THEN reverse(text) END AS text FROM items")
def items_with_texts(read):
    it = items(read)
    texts = it.filter((F.col("coll") + F.col("seq")) % 4 != 0).select("ref", F.reverse("text").alias("rendered"))
    return it.join(texts, "ref", "left").select("ref", F.col("rendered").alias("text"))


@query("src6_completed_only", f"WITH {ITEMS} SELECT ref, reverse(text) AS text FROM items WHERE (coll + seq) % 4 <> 0")
def completed_only(read):
    it = items(read)
    texts = it.select("ref", F.reverse("text").alias("rendered"), F.when((F.col("coll") + F.col("seq")) % 4 != 0, "complete").otherwise("failed").alias("status"))
    return it.join(texts.filter("status = 'complete'"), "ref").select("ref", F.col("rendered").alias("text"))


@query("snk2_bilingual_rows", f"WITH {ITEMS} SELECT coll, seq, ref || ' ' || coalesce(CASE WHEN (coll + seq) % 6 <> 0 THEN text END, '[UNTRANSLATED ' || ref || ']') AS line FROM items")
def bilingual_rows(read):
    shown = F.when((F.col("coll") + F.col("seq")) % 6 != 0, F.col("text"))
    return items(read).select("coll", "seq", F.concat("ref", F.lit(" "), F.coalesce(shown, F.concat(F.lit("[UNTRANSLATED "), "ref", F.lit("]")))).alias("line"))


@query("snk3_flat_edition", f"WITH {ITEMS} SELECT ref || chr(9) || text AS line FROM items")
def flat_edition(read):
    return items(read).select(F.format_string("%s\t%s", "ref", "text").alias("line"))


@query("agg19_collection_fingerprint", f"WITH {ITEMS} SELECT coll, sha256(string_agg(ref || chr(9) || text, chr(10) ORDER BY seq)) AS digest FROM items GROUP BY coll")
def collection_fingerprint(read):
    pieces = F.array_sort(F.collect_list(F.struct("seq", F.format_string("%s\t%s", "ref", "text").alias("line"))))
    return items(read).groupBy("coll").agg(F.sha2(F.array_join(F.transform(pieces, lambda p: p["line"]), "\n").cast("binary"), 256).alias("digest"))
