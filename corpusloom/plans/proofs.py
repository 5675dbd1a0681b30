"""Queries on words, digests, sections, tables kept in place and files."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions.storage import fresh_path
from corpusloom.operators import coverage as K
from corpusloom.operators import sections as S
from corpusloom.plans.base import ITEMS, items, query
from corpusloom.sources import files, versions

WORDS = r"list_filter(regexp_split_to_array(coalesce({0}, ''), '[ \t\r\n]+'), lambda x: x <> '')"

# --- failed leaves, split by words

#: Every conversation not divisible by three is a failed leaf; of every other one only the first turn is left.
LEAVES = f"lines AS (SELECT conv_id AS leaf, turn AS place, text, {WORDS.format('text')} AS w FROM conversations WHERE conv_id % 3 <> 0 AND (conv_id % 2 = 0 OR turn = 0))"


def wrap_sql(source: str, limit: int) -> str:
    """CTEs that wrap the words of ``source`` (leaf, place, w) to lines (leaf, place, k, a, z: first and last word)."""
    return f"""wd AS MATERIALIZED (SELECT leaf, place, i, length(w[i]) AS c FROM (SELECT leaf, place, w, unnest(range(1, len(w) + 1)) AS i FROM {source})),
wf AS (SELECT leaf, place, i, 0 AS k, c AS tot FROM wd WHERE i = 1
 UNION ALL SELECT wd.leaf, wd.place, wd.i, CASE WHEN tot + 1 + c > {limit} THEN k + 1 ELSE k END, CASE WHEN tot + 1 + c > {limit} THEN c ELSE tot + 1 + c END FROM wf JOIN wd ON wd.leaf = wf.leaf AND wd.place = wf.place AND wd.i = wf.i + 1),
wl AS (SELECT leaf, place, k, min(i) AS a, max(i) AS z FROM wf GROUP BY leaf, place, k)"""


SPLIT = f"""{LEAVES}, {wrap_sql('lines', 90)},
n AS (SELECT *, count(*) OVER (PARTITION BY leaf) AS m FROM lines), c AS (SELECT leaf, place, count(*) AS pieces FROM wl GROUP BY leaf, place),
j AS (SELECT n.leaf, n.place, n.w, CASE WHEN len(w) = 0 THEN 'empty_line' WHEN m = 1 AND pieces = 1 AND len(w) < 2 THEN 'irreducible' END AS problem, m = 1 AND pieces = 1 AS alone FROM n LEFT JOIN c ON c.leaf = n.leaf AND c.place = n.place),
p AS (SELECT j.leaf, j.place, k, array_to_string(w[a:z], ' ') AS piece FROM j JOIN wl ON wl.leaf = j.leaf AND wl.place = j.place WHERE problem IS NULL AND NOT alone
 UNION ALL SELECT leaf, place, h, array_to_string(CASE h WHEN 0 THEN w[1:(len(w) + 1) // 2] ELSE w[(len(w) + 1) // 2 + 1:] END, ' ') FROM j, (VALUES (0), (1)) x(h) WHERE problem IS NULL AND alone),
split AS (SELECT leaf, row_number() OVER (PARTITION BY leaf ORDER BY place, k)::INT AS index, place, piece, NULL AS problem FROM p UNION ALL SELECT leaf, NULL, place, NULL, problem FROM j WHERE problem IS NOT NULL)"""


def _lines(read):
    c = read("conversations").filter("conv_id % 3 <> 0 and (conv_id % 2 = 0 or turn = 0)")
    return c.select(F.col("conv_id").alias("leaf"), F.col("turn").alias("place"), "text")


def _split(read):
    return K.split_failed(_lines(read), "leaf", "place", "text", 90)


@query("win9_failed_leaf_words", f"WITH RECURSIVE {SPLIT} SELECT * FROM split")
def failed_leaf_words(read):
    return _split(read)


@query("win9_word_coverage", f"""WITH RECURSIVE {SPLIT}, kept AS (SELECT leaf, index, CASE WHEN leaf % 7 = 1 AND index = 1 THEN array_to_string({WORDS.format('piece')}[1:len({WORDS.format('piece')}) - 1], ' ') WHEN leaf % 7 = 2 THEN piece END AS lost, piece FROM split WHERE problem IS NULL),
b AS (SELECT leaf, list(x ORDER BY index, i) AS w FROM (SELECT leaf, index, unnest(w) AS x, unnest(range(0, len(w))) AS i FROM (SELECT leaf, CASE WHEN leaf % 7 = 2 THEN -index ELSE index END AS index, {WORDS.format("CASE WHEN leaf % 7 = 1 AND index = 1 THEN lost ELSE piece END")} AS w FROM kept)) GROUP BY leaf),
a AS (SELECT leaf, list(x ORDER BY place, i) AS w FROM (SELECT leaf, place, unnest(w) AS x, unnest(range(0, len(w))) AS i FROM lines) GROUP BY leaf)
SELECT a.leaf, len(a.w) AS words, coalesce(len(b.w), 0) AS piece_words, coalesce(a.w = b.w, false) AS covered FROM a LEFT JOIN b USING (leaf)""")
def word_coverage(read):
    """Of some leaves the first piece has lost its last word, of others the pieces are in the wrong order."""
    k, words = F.col("leaf") % 7, K.words_of(F.col("piece"))
    shorter = F.array_join(F.slice(words, F.lit(1), F.size(words) - 1), " ")
    pieces = _split(read).filter("problem is null").select("leaf", F.when(k == 2, -F.col("index")).otherwise(F.col("index")).alias("index"), F.when((k == 1) & (F.col("index") == 1), shorter).otherwise(F.col("piece")).alias("piece"))
    return K.word_coverage(_lines(read), "place", "text", pieces, "index", "piece", "leaf")


#: A clause ends at one of these signs, the pieces merge up to 120, what stays one piece of over 140 wraps at 100.
CLAUSE = "[^.,;:!?]+[.,;:!?]*"


@query("win11_wrapped_clauses", f"""WITH RECURSIVE t AS (SELECT conv_id || ':' || (turn + 1) AS ref, text FROM conversations), pieces AS (SELECT ref AS leaf, 0 AS place, text, list_filter(list_transform(regexp_extract_all(text, '{CLAUSE}'), lambda p: trim(p)), lambda p: p <> '') AS w FROM t),
{wrap_sql('pieces', 120)}, m AS (SELECT leaf, list(array_to_string(w[a:z], ' ') ORDER BY k) AS lines FROM pieces JOIN wl USING (leaf) GROUP BY leaf), one AS (SELECT leaf || '/w' AS leaf, 0 AS place, {WORDS.format('text')} AS w FROM pieces JOIN m USING (leaf) WHERE len(lines) = 1 AND length(text) > 140),
{wrap_sql('one', 100).replace('wd', 'vd').replace('wf', 'vf').replace('wl', 'vl')}, r AS (SELECT leaf, list(array_to_string(w[a:z], ' ') ORDER BY k) AS lines FROM one JOIN vl USING (leaf) GROUP BY leaf)
SELECT ref, array_to_string(coalesce(r.lines, m.lines, []), chr(10)) AS lines FROM t LEFT JOIN m ON m.leaf = ref LEFT JOIN r ON r.leaf = ref || '/w'""")
def wrapped_clauses(read):
    return items(read).select("ref", F.array_join(K.clause_lines(F.col("text"), CLAUSE, 120, 140, 100), "\n").alias("lines"))


# --- digests of ordered tables

FAN = 16


def merkle_sql(leaves: str, levels: int = 6) -> str:
    """CTEs m0..: the nodes of a tree over ``leaves`` (i from 0, d)."""
    out = [f"m0 AS ({leaves})"]
    for k in range(levels):
        whole = f"SELECT i // {FAN} AS i, CASE WHEN (SELECT count(*) FROM m{k}) = 1 THEN min(d) ELSE sha256(string_agg(d, '' ORDER BY i)) END AS d FROM m{k} GROUP BY i // {FAN}"
        out.append(f"m{k + 1} AS ({whole})")
    return ", ".join(out)


@query("agg19_corpus_digest", f"""WITH {ITEMS}, {merkle_sql("SELECT row_number() OVER (ORDER BY coll, seq) - 1 AS i, sha256(ref || chr(9) || text) AS d FROM items")} SELECT (SELECT count(*) FROM items) AS rows, d AS digest FROM m6""")
def corpus_digest(read):
    return K.merkle(items(read), [], ["coll", "seq"], F.concat("ref", F.lit("\t"), "text"), FAN)


@query("agg19_collection_digests", """WITH l AS (SELECT source, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS i, count(*) OVER (PARTITION BY source) AS n, sha256(coalesce(text, '')) AS d FROM documents),
a AS (SELECT source, n, i // 64 AS i, CASE WHEN n = 1 THEN min(d) ELSE sha256(string_agg(d, '' ORDER BY i)) END AS d FROM l GROUP BY source, n, i // 64), b AS (SELECT source, n, i // 64 AS i, CASE WHEN n <= 64 THEN min(d) ELSE sha256(string_agg(d, '' ORDER BY i)) END AS d FROM a GROUP BY source, n, i // 64),
c AS (SELECT source, n, i // 64 AS i, CASE WHEN n <= 4096 THEN min(d) ELSE sha256(string_agg(d, '' ORDER BY i)) END AS d FROM b GROUP BY source, n, i // 64) SELECT source, n AS rows, d AS digest FROM c""")
def collection_digests(read):
    return K.merkle(read("documents").select("source", "doc_id", "text"), ["source"], ["doc_id"], F.coalesce("text", F.lit("")), 64)


# --- sections of any length

#: Section k begins at 3 * k * k; some end early, some late, one out of five expects a wrong number.
SECTIONS = """s AS (SELECT k AS section, doc_id AS first, 3 * (k + 1) * (k + 1) - 1 - CASE k % 4 WHEN 1 THEN 2 ELSE 0 END + CASE k % 5 WHEN 2 THEN 3 ELSE 0 END AS last FROM (SELECT doc_id, floor(sqrt(doc_id / 3.0))::BIGINT AS k FROM documents) WHERE 3 * k * k = doc_id),
d AS (SELECT doc_id, arg_max(s.section, s.first) AS section, arg_max(s.last, s.first) AS last FROM documents LEFT JOIN s ON s.first <= doc_id GROUP BY doc_id), a AS (SELECT doc_id, CASE WHEN doc_id <= last THEN section END AS section FROM d)"""


def _sections(read):
    k = F.floor(F.sqrt(F.col("doc_id") / 3.0)).cast("long")
    starts = read("documents").select("doc_id", k.alias("k")).filter("3 * k * k = doc_id")
    last = 3 * (F.col("k") + 1) * (F.col("k") + 1) - 1 - F.when(F.col("k") % 4 == 1, 2).otherwise(0) + F.when(F.col("k") % 5 == 2, 3).otherwise(0)
    ranges = starts.select(F.col("k").alias("section"), F.col("doc_id").alias("first"), last.alias("last"))
    return ranges.withColumn("expected", F.col("last") - F.col("first") + 1 + F.when(F.col("section") % 5 == 3, 1).otherwise(0))


@query("jon4_irregular_sections", f"WITH {SECTIONS} SELECT doc_id, section FROM a")
def irregular_sections(read):
    return S.assign_sections(read("documents").select("doc_id"), _sections(read), "doc_id").select("doc_id", "section")


@query("jon4_section_audit", f"""WITH {SECTIONS}, c AS (SELECT section, count(*) AS items FROM a GROUP BY section), l AS (SELECT s.*, lag(last) OVER (ORDER BY first) AS prev, coalesce(items, 0) AS items, last - first + 1 + (section % 5 = 3)::BIGINT AS expected FROM s LEFT JOIN c USING (section))
SELECT section, items, unnest(CASE WHEN len(p) = 0 THEN ['ok'] ELSE p END) AS problem FROM (SELECT section, items, list_filter([CASE WHEN last < first THEN 'empty_range' END, CASE WHEN first > prev + 1 THEN 'gap' END, CASE WHEN first <= prev THEN 'overlap' END, CASE WHEN items <> expected THEN 'count' END], lambda x: x IS NOT NULL) AS p FROM l)""")
def section_audit(read):
    sections = _sections(read)
    return S.section_audit(S.assign_sections(read("documents").select("doc_id"), sections, "doc_id"), sections)


# --- tables kept under a path

ISSUES = "SELECT source, doc_id, 'long' AS code FROM documents WHERE length(text) > 1500"


@query("set5_replaced_scopes", f"""SELECT source, doc_id, code FROM ({ISSUES}) WHERE source NOT IN ('src1', 'src2', 'src3') UNION ALL SELECT source, doc_id, 'short' FROM documents WHERE source IN ('src1', 'src3') AND length(text) < 400""")
def replaced_scopes(read):
    d = read("documents")
    path = fresh_path(d.sparkSession, "scopes")
    issues = lambda rows, code: rows.select("source", "doc_id", F.lit(code).alias("code"))
    issues(d.filter(F.length("text") > 1500), "long").write.partitionBy("source").parquet(path)
    again = issues(d.filter(F.col("source").isin("src1", "src3") & (F.length("text") < 400)), "short")
    return versions.replace_scopes(path, again, "source", ["src1", "src2", "src3"])


@query("src2_staged_replacement", "SELECT 1 AS step, 'replace' AS action, count(*) AS rows, count(*) FILTER (text LIKE '%.') AS dotted FROM documents UNION ALL SELECT 2, 'noop', count(*), count(*) FILTER (text LIKE '%.') FROM documents UNION ALL SELECT 3, 'reject', count(*), count(*) FILTER (text LIKE '%.') FROM documents UNION ALL SELECT 4, 'replace', count(*), count(*) FROM (SELECT text FROM documents WHERE text IS NOT NULL)")
def staged_replacement(read):
    """A first import, the same again, a changed one while labels depend on the rows, and that one once nothing does: what holds after each."""
    d = read("documents").select("doc_id", "text")
    store = versions.VersionedTable(d.sparkSession, fresh_path(d.sparkSession, "store"))
    changed = d.filter("text is not null").withColumn("text", F.concat("text", F.lit(".")))
    labels = read("labels")
    out = None
    for step, (rows, needs) in enumerate([(d, labels), (d, labels), (changed, labels), (changed, labels.filter("false"))], 1):
        action = versions.reimport(store, rows, needs, "doc_id", "text")
        now = store.current().agg(F.lit(step).alias("step"), F.lit(action).alias("action"), F.count(F.lit(1)).alias("rows"), F.count_if(F.endswith("text", F.lit("."))).alias("dotted"))
        out = now if out is None else out.unionByName(now)
    return out


@query("snk5_file_manifest", f"WITH {ITEMS} SELECT 'coll=' || coll AS name, strlen(b) AS bytes, sha256(b) AS digest FROM (SELECT coll, string_agg(ref || ' ' || replace(text, chr(10), ' ') || chr(10), '' ORDER BY seq) AS b FROM items GROUP BY coll)")
def file_manifest(read):
    """An edition of one file a collection, and the manifest of the files as they stand."""
    it = items(read)
    path = fresh_path(it.sparkSession, "edition")
    line = F.concat("ref", F.lit(" "), F.replace("text", F.lit("\n"), F.lit(" ")))
    it.select("coll", "seq", line.alias("value")).repartition("coll").sortWithinPartitions("coll", "seq").select("coll", "value").write.partitionBy("coll").text(path)
    return files.artifact_manifest(it.sparkSession, path, "*/part-*").select(F.regexp_extract("name", "^([^/]*)/", 1).alias("name"), "bytes", "digest")
