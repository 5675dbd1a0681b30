"""Queries on text rules, duplicate groups, contracts and layered resolution."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.operators import resolve as V
from corpusloom.operators import rules as R
from corpusloom.plans.base import ITEMS, items, query

TERMS = ["idiot", "moron", "scum", "trash"]


@query("prj6_rule_issues", r"""SELECT doc_id, 'pipe' AS code, 'warning' AS severity FROM documents WHERE contains(text, ' | ') UNION ALL SELECT doc_id, 'shout', 'error' FROM documents WHERE regexp_matches(text, '[A-Z]{4,}!!')
UNION ALL SELECT doc_id, 'paren', 'warning' FROM documents WHERE regexp_matches(text, '\([^)]*\)')""")
def rule_issues(read):
    rules = {"pipe": (r" \| ", "warning"), "shout": (r"[A-Z]{4,}!!", "error"), "paren": (r"\([^)]*\)", "warning")}
    return R.rule_issues(read("documents"), "doc_id", "text", rules)


@query("prj7_keyed_term_rules", """WITH r AS (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'required' ELSE 'forbidden' END AS kind, CASE WHEN doc_id % 3 = 0 THEN 'the' ELSE 'and' END AS term FROM labels)
SELECT doc_id, kind, term FROM r JOIN documents USING (doc_id) WHERE contains(text, term) = (kind = 'forbidden')""")
def keyed_rules(read):
    kind = F.when(F.col("doc_id") % 2 == 0, "required").otherwise("forbidden")
    term = F.when(F.col("doc_id") % 3 == 0, "the").otherwise("and")
    return R.keyed_term_rules(read("documents"), read("labels").select("doc_id", kind.alias("kind"), term.alias("term")), "doc_id", "text")


@query("prj8_formula_patterns", r"SELECT doc_id, regexp_extract(text, '[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}') AS address, regexp_extract(text, '([0-9]{4}) [0-9]{4}', 1) AS number FROM documents")
def formulas(read):
    t = F.col("text")
    return read("documents").select("doc_id", F.regexp_extract(t, r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}", 0).alias("address"), F.regexp_extract(t, r"([0-9]{4}) [0-9]{4}", 1).alias("number"))


@query("prj12_script_check", "SELECT doc_id, CASE WHEN NOT regexp_matches(text, '[A-Za-z]') THEN 'missing_script' WHEN regexp_matches(text, '[ßäöü]') THEN 'forbidden_script' ELSE 'ok' END AS status FROM documents")
def script(read):
    return read("documents").select("doc_id", R.script_check(F.col("text"), "[A-Za-z]", "[ßäöü]").alias("status"))


FINDINGS = "f AS (SELECT labels.doc_id, CASE WHEN toxic = 1 THEN 'blocking' ELSE 'minor' END AS severity, substr(text, 1, 20) AS quote FROM labels JOIN documents USING (doc_id) WHERE toxic = 1 OR quality = 0)"


def _findings(read):
    joined = read("labels").filter("toxic = 1 or quality = 0").join(read("documents"), "doc_id")
    return joined.select("doc_id", F.when(F.col("toxic") == 1, "blocking").otherwise("minor").alias("severity"), F.substring("text", 1, 20).alias("quote"))


@query("prj13_stale_findings", f"WITH {FINDINGS}, t AS (SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN replace(text, ' ', '_') ELSE text END AS text FROM documents) SELECT doc_id, severity FROM f JOIN t USING (doc_id) WHERE contains(text, quote)")
def stale(read):
    now = read("documents").select("doc_id", F.when(F.col("doc_id") % 7 == 0, F.replace("text", F.lit(" "), F.lit("_"))).otherwise(F.col("text")).alias("text"))
    return _findings(read).join(now, "doc_id").filter(F.contains("text", "quote")).select("doc_id", "severity")


@query("prj14_failure_classes", "SELECT event_id, CASE WHEN contains(m, 'error') THEN 'retryable' WHEN contains(m, 'purchase') OR contains(m, 'signup') THEN 'billing' ELSE 'other' END AS class FROM (SELECT event_id, lower(event_type || ' failed') AS m FROM events)")
def failures(read):
    rules = [("retryable", ["error"]), ("billing", ["purchase", "signup"])]
    return read("events").select("event_id", R.classify(F.concat("event_type", F.lit(" failed")), rules, "other").alias("class"))


RENDERED = "CASE WHEN doc_id % 7 = 0 THEN reverse(text) WHEN doc_id % 5 <> 0 THEN text END"


@query("set2_group_closure", r"""WITH h AS (SELECT doc_id, sha256(trim(regexp_replace(nfc_normalize(text), '[\s\x0B\x{85}\p{Z}\x1C-\x1F]+', ' ', 'g'))) AS g FROM documents), t AS (SELECT doc_id FROM documents WHERE doc_id % 9 = 0),
x AS (SELECT DISTINCT g FROM h JOIN t USING (doc_id)) SELECT doc_id, doc_id % 9 <> 0 AS closure_only FROM h WHERE g IN (SELECT g FROM x)""")
def closure(read):
    d = read("documents")
    return V.closure(d.filter("doc_id % 9 = 0"), V.duplicate_groups(d, "doc_id", "text"), "doc_id")


@query("res2_staged_overlay", """SELECT doc_id, CASE WHEN doc_id % 11 = 0 THEN '2:' || text WHEN doc_id % 7 = 0 THEN '1:' || text ELSE text END AS final_text, CASE WHEN doc_id % 11 = 0 THEN 'repair' WHEN doc_id % 7 = 0 THEN 'revision' ELSE 'draft' END AS layer FROM documents""")
def staged(read):
    d = read("documents").select("doc_id", "text")
    layers = [("revision", d.filter("doc_id % 7 = 0").withColumn("text", F.concat(F.lit("1:"), "text"))), ("repair", d.filter("doc_id % 11 = 0").withColumn("text", F.concat(F.lit("2:"), "text")))]
    return V.staged_overlay(d, layers, "doc_id")


@query("res6_group_override", r"""WITH h AS (SELECT doc_id, text, sha256(trim(regexp_replace(nfc_normalize(text), '[\s\x0B\x{85}\p{Z}\x1C-\x1F]+', ' ', 'g'))) AS g FROM documents), s AS (SELECT g, min(doc_id) AS chosen FROM h GROUP BY g HAVING count(*) > 1)
SELECT h.doc_id, CASE WHEN s.g IS NULL THEN text ELSE 'group ' || chosen END AS final_text FROM h LEFT JOIN s USING (g)""")
def group_override(read):
    d = read("documents").select("doc_id", "text")
    groups = V.duplicate_groups(d, "doc_id", "text")
    chosen = groups.groupBy("group_id").agg(F.concat(F.lit("group "), F.min("doc_id")).alias("choice"))
    named = groups.join(chosen, "group_id").select("doc_id", "choice")
    return d.join(named, "doc_id", "left").select("doc_id", F.coalesce("choice", "text").alias("final_text"))


@query("res7_guarded_edit", """WITH e AS (SELECT doc_id, text, CASE WHEN doc_id % 17 = 0 THEN '' ELSE substr(text, 1, 12 + doc_id % 9) END AS b FROM documents), o AS (SELECT *, (length(text) - length(replace(text, b, ''))) // nullif(length(b), 0) AS n FROM e)
SELECT doc_id, CASE WHEN text IS NULL THEN 'no_text' WHEN n IS NULL THEN 'no_before' WHEN n = 1 THEN 'applied' WHEN n = 0 THEN 'missing' ELSE 'ambiguous' END AS status, md5(CASE WHEN n = 1 THEN replace(text, b, 'EDIT') ELSE text END) AS digest FROM o""")
def guarded_edit(read):
    k = F.col("doc_id")
    before = F.when(k % 17 == 0, "").otherwise(F.substring(F.col("text"), F.lit(1), (k % 9 + 12).cast("int")))
    d = read("documents").withColumn("b", before).withColumn("a", F.lit("EDIT"))
    return V.guarded_edit(d, "text", "b", "a").select("doc_id", "status", F.md5("new_text").alias("digest"))


@query("con6_decision_contract", f"""WITH {FINDINGS}, d AS (SELECT doc_id FROM f WHERE doc_id % 3 <> 0 UNION ALL SELECT doc_id FROM f WHERE doc_id % 5 = 0 UNION ALL SELECT doc_id + 1000000 FROM f WHERE doc_id % 17 = 0), c AS (SELECT doc_id, count(*) AS n FROM d GROUP BY doc_id)
SELECT coalesce(f.doc_id, c.doc_id) AS doc_id, CASE WHEN f.doc_id IS NULL THEN 'unknown_finding' WHEN n IS NULL THEN 'undecided' ELSE 'decided_twice' END AS problem FROM f FULL JOIN c ON f.doc_id = c.doc_id WHERE f.doc_id IS NULL OR n IS NULL OR n > 1""")
def decision_contract(read):
    f = _findings(read).select("doc_id")
    d = f.filter("doc_id % 3 <> 0").union(f.filter("doc_id % 5 = 0")).union(f.filter("doc_id % 17 = 0").select(F.col("doc_id") + 1000000))
    return V.decision_contract(f, d, "doc_id")


@query("con7_accept_contract", f"""WITH {FINDINGS} SELECT doc_id, severity, CASE WHEN doc_id % 2 = 0 AND severity = 'blocking' THEN 'accepted_with_severe' WHEN doc_id % 2 = 1 AND severity <> 'blocking' THEN 'rejected_without_severe' ELSE 'ok' END AS status FROM f""")
def accept_contract(read):
    status = V.accept_status(F.col("severity") == "blocking", F.col("doc_id") % 2 == 0)
    return _findings(read).select("doc_id", "severity", status.alias("status"))


@query("res4_finding_disposition", f"""WITH {FINDINGS} SELECT doc_id, CASE WHEN severity = 'minor' THEN 'advisory' WHEN doc_id % 3 = 0 AND doc_id % 2 = 0 THEN 'repaired_and_verified' WHEN doc_id % 3 = 1 THEN 'rejected_base_verified' ELSE 'unresolved_fallback' END AS disposition FROM f""")
def disposition(read):
    k = F.col("doc_id")
    decision = F.when(k % 3 == 0, "applied").when(k % 3 == 1, "rejected").otherwise("escalated")
    accept = (k % 3 == 1) | (k % 2 == 0)
    return _findings(read).select("doc_id", V.disposition(F.col("severity"), ["blocking"], decision, accept).alias("disposition"))


@query("res1_finding_ids", f"WITH {FINDINGS} SELECT doc_id, 'qa-' || substr(sha256(doc_id || '|' || severity || '|' || quote), 1, 16) AS finding_id FROM f")
def finding_ids(read):
    return _findings(read).select("doc_id", V.finding_id(["doc_id", "severity", "quote"]).alias("finding_id"))


@query("jon7_finding_decision_verification", f"""WITH {FINDINGS} SELECT doc_id, severity, CASE doc_id % 3 WHEN 0 THEN 'applied' WHEN 1 THEN 'rejected' END AS decision, CASE WHEN doc_id % 4 <> 0 THEN doc_id % 2 = 0 END AS accept FROM f""")
def decided(read):
    f = _findings(read)
    d = f.filter("doc_id % 3 <> 2").select("doc_id", F.when(F.col("doc_id") % 3 == 0, "applied").otherwise("rejected").alias("decision"))
    v = f.filter("doc_id % 4 <> 0").select("doc_id", (F.col("doc_id") % 2 == 0).alias("accept"))
    return V.decided(f, d, v, "doc_id", "doc_id").select("doc_id", "severity", "decision", "accept")


@query("jon13_referenced_sources", f"WITH {FINDINGS} SELECT doc_id, 'src' || doc_id % 30 AS source FROM f WHERE 'src' || doc_id % 30 NOT IN (SELECT DISTINCT source FROM documents)")
def referenced(read):
    f = _findings(read).select("doc_id", F.concat(F.lit("src"), F.col("doc_id") % 30).alias("source"))
    return f.join(read("documents").select("source").distinct(), "source", "left_anti").select("doc_id", "source")


@query("res12_compatible_reuse", "WITH n AS (SELECT doc_id, md5(text) AS h FROM documents), o AS (SELECT doc_id, CASE WHEN doc_id % 6 = 0 THEN 'changed' ELSE md5(text) END AS h FROM documents WHERE doc_id % 4 <> 0) SELECT n.doc_id, CASE WHEN o.h IS NULL THEN 'new' WHEN o.h = n.h THEN 'reused' ELSE 'changed' END AS status FROM n LEFT JOIN o USING (doc_id)")
def reuse(read):
    now = read("documents").select("doc_id", F.md5("text").alias("h"))
    old = now.filter("doc_id % 4 <> 0").select("doc_id", F.when(F.col("doc_id") % 6 == 0, "changed").otherwise(F.col("h")).alias("o"))
    return now.join(old, "doc_id", "left").select("doc_id", F.when(F.col("o").isNull(), "new").when(F.col("o") == F.col("h"), "reused").otherwise("changed").alias("status"))


@query("src2_reimport_diff", "WITH n AS (SELECT doc_id, md5(CASE WHEN doc_id % 8 = 0 THEN text || '.' ELSE text END) AS h FROM documents WHERE doc_id % 10 <> 0) SELECT d.doc_id, CASE WHEN n.h IS NULL THEN 'removed' ELSE 'changed' END AS change FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id WHERE n.h IS NULL OR n.h <> md5(d.text)")
def reimport(read):
    d = read("documents")
    new = d.filter("doc_id % 10 <> 0").select("doc_id", F.md5(F.when(F.col("doc_id") % 8 == 0, F.concat("text", F.lit("."))).otherwise(F.col("text"))).alias("n"))
    both = d.select("doc_id", F.md5("text").alias("o")).join(new, "doc_id", "full")
    change = F.when(F.col("n").isNull(), "removed").when(F.col("o").isNull(), "added").when(F.col("n") != F.col("o"), "changed")
    return both.withColumn("change", change).filter("change is not null").select("doc_id", "change")


@query("set4_upsert", "SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'new' ELSE source END AS value FROM documents UNION ALL SELECT doc_id + 5000000, 'new' FROM documents WHERE doc_id % 50 = 0")
def upsert(read):
    d = read("documents")
    old = d.select("doc_id", F.col("source").alias("value"), F.lit(0).alias("v"))
    new = d.filter("doc_id % 5 = 0").select("doc_id", F.lit("new").alias("value"), F.lit(1).alias("v"))
    added = d.filter("doc_id % 50 = 0").select((F.col("doc_id") + 5000000).alias("doc_id"), F.lit("new").alias("value"), F.lit(1).alias("v"))
    return V.latest_wins(old.union(new).union(added), ["doc_id"], [F.desc("v")]).select("doc_id", "value")


@query("set1_issue_union", r"""SELECT doc_id, 'pipe' AS code, 'warning' AS severity FROM documents WHERE contains(text, ' | ') UNION ALL SELECT doc_id, 'toxic', 'error' FROM labels WHERE toxic = 1 UNION ALL SELECT doc_id, 'low_quality', 'warning' FROM labels WHERE quality = 0""")
def issue_union(read):
    pipe = R.rule_issues(read("documents"), "doc_id", "text", {"pipe": (r" \| ", "warning")})
    lab = read("labels")
    toxic = lab.filter("toxic = 1").select("doc_id", F.lit("toxic").alias("code"), F.lit("error").alias("severity"))
    low = lab.filter("quality = 0").select("doc_id", F.lit("low_quality").alias("code"), F.lit("warning").alias("severity"))
    return pipe.unionByName(toxic).unionByName(low)


@query("agg23_gate_verdict", "SELECT count(*) FILTER (toxic = 1) AS errors, count(*) FILTER (quality = 0) AS warnings, count(*) FILTER (toxic = 1) = 0 AS passed FROM labels")
def gate_verdict(read):
    lab = read("labels")
    return V.verdict(lab.filter("toxic = 1").select(F.lit("error").alias("severity")).unionByName(lab.filter("quality = 0").select(F.lit("warning").alias("severity"))))


@query("agg21_prompt_sizes", r"SELECT source, count(*) AS n, min(length(text)) AS lo, max(length(text)) AS hi, sum(length(text))::BIGINT AS total, sum(len(regexp_extract_all(text, '[A-Za-z0-9'']+')))::BIGINT AS words FROM documents GROUP BY source")
def prompt_sizes(read):
    from corpusloom.operators.evals import word_count

    n = F.length("text").cast("long")
    return read("documents").groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.min(n).alias("lo"), F.max(n).alias("hi"), F.sum(n).alias("total"), F.sum(word_count(F.col("text"))).alias("words"))


@query("snk5_text_manifest", "SELECT doc_id, sha256(text) AS digest, strlen(text) AS bytes FROM documents")
def manifest(read):
    return read("documents").select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("digest"), F.octet_length("text").cast("long").alias("bytes"))


@query("gat17_digest_match", "SELECT d.doc_id, CASE WHEN doc_id % 13 = 0 THEN 'missing' WHEN doc_id % 7 = 0 THEN 'changed' ELSE 'ok' END AS status FROM documents d")
def digest_match(read):
    d = read("documents").select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("recorded"))
    actual = read("documents").filter("doc_id % 13 <> 0").select("doc_id", F.sha2(F.when(F.col("doc_id") % 7 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text")).cast("binary"), 256).alias("actual"))
    status = F.when(F.col("actual").isNull(), "missing").when(F.col("actual") != F.col("recorded"), "changed").otherwise("ok")
    return d.join(actual, "doc_id", "left").select("doc_id", status.alias("status"))


@query("gat2_run_gate", f"""WITH {ITEMS}, i AS (
 SELECT ref, 'missing_text' AS code, 'error' AS severity FROM items WHERE (coll * 7 + seq) % 13 = 0
 UNION ALL SELECT ref, 'banned_term', 'error' FROM items WHERE regexp_matches(text, '(?i)\\b(idiot|moron|scum|trash)\\b') AND (coll * 7 + seq) % 13 <> 0
 UNION ALL SELECT ref, 'bracket', 'warning' FROM items WHERE contains(text, '[') AND (coll * 7 + seq) % 13 <> 0)
SELECT * FROM i UNION ALL SELECT '*', 'verdict', CASE WHEN count(*) FILTER (severity = 'error') = 0 THEN 'pass' ELSE 'fail' END FROM i""")
def run_gate(read):
    it = items(read)
    texts = it.filter((F.col("coll") * 7 + F.col("seq")) % 13 != 0)
    missing = it.join(texts.select("ref"), "ref", "left_anti").select("ref", F.lit("missing_text").alias("code"), F.lit("error").alias("severity"))
    broken = R.rule_issues(texts, "ref", "text", {"banned_term": (r"(?i)\b(idiot|moron|scum|trash)\b", "error"), "bracket": (r"\[", "warning")})
    issues = missing.unionByName(broken)
    line = V.verdict(issues).select(F.lit("*").alias("ref"), F.lit("verdict").alias("code"), F.when(F.col("passed"), "pass").otherwise("fail").alias("severity"))
    return issues.unionByName(line)
