"""URL filters as a temporal list join.

List entries are dated: an entry adds or removes a rule at a time.  Per list
and rule the entries become validity intervals [from, to); every capture is
then joined, as of its fetch time, with the intervals of its own keys (each
suffix of its host and the first path segment under the host).  A capture is
blocked if an active block rule matches and no active allow rule does.

The join is an equi-join on the key with the time as residual predicate; a
capture has as many keys as its host has labels, so nothing is multiplied by
the size of a host.  Up to SMALL_LIST intervals, counted first, are broadcast.
A longer list is shuffled: keys that no rule has go before the shuffle where
they are short (top-level and second-level domains, which most captures share),
and every key is dealt to SALTS tasks, so a popular host is no hot key.

Defined edge cases: a capture with a null or hostless url, or without a fetch
time, matches nothing and is kept; entries without rule or time are ignored;
of entries of one rule at one time, 'add' counts before 'remove' is seen, so
the removal holds; repeated adds change nothing; repeated captures are judged
each, with the counts of one; an empty list blocks nothing and an empty table
gives an empty result.  Extra columns of both tables are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import table

HOST = r"^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]+)"
SMALL_LIST = 200_000
SALTS = 16
SEGMENT = r"^[a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*/([^/?#]+)"


def host_of(url: Column) -> Column:
    """Lower-case host without a leading ``www.`` and trailing dot; empty if there is none."""
    return F.regexp_replace(F.lower(F.coalesce(F.regexp_extract(url, HOST, 1), F.lit(""))), r"^www\.|\.$", "")


def rule_keys(host: Column, url: Column) -> Column:
    """Keys under which a rule can name a capture: host suffixes, and host/first-segment."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    suffixes = F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(labels, i, n), "."))
    path = F.concat(host, F.lit("/"), F.regexp_extract(url, SEGMENT, 1))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.array_distinct(F.concat(suffixes, F.array(path))))


def validity_intervals(entries: DataFrame) -> DataFrame:
    """(list, rule, valid_from, valid_to): times between an 'add' and the next change of the same rule."""
    known = entries.filter(F.col("rule").isNotNull() & F.col("effective_at").isNotNull())
    last = known.groupBy("list", "rule", "effective_at").agg(F.max("action").alias("action"))  # 'remove' sorts after 'add'
    following = Window.partitionBy("list", "rule").orderBy("effective_at")
    spans = last.withColumn("valid_to", F.lead("effective_at").over(following))
    return spans.filter("action = 'add'").select("list", "rule", F.col("effective_at").alias("valid_from"), "valid_to")


def active_rules(keys: DataFrame, intervals: DataFrame, small_list: int = SMALL_LIST) -> DataFrame:
    """keys (.., fetched_at, key) with the list and rule of each interval that holds their fetch time."""
    spans = intervals.withColumnRenamed("rule", "key")
    on = (F.col("fetched_at") >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col("fetched_at") < F.col("valid_to")))
    if spans.limit(small_list + 1).count() <= small_list:
        return keys.join(F.broadcast(spans), "key").filter(on)
    short = F.size(F.split("key", r"\.")) <= 2
    named = spans.filter(short).select("key").distinct()
    if named.limit(small_list + 1).count() <= small_list:
        keys = keys.filter(~short).unionByName(keys.filter(short).join(F.broadcast(named), "key", "left_semi"))
    salted = keys.withColumn("_salt", F.pmod(F.xxhash64("page_id", "url", "fetched_at"), F.lit(SALTS)).cast("int"))
    dealt = spans.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(dealt, ["key", "_salt"]).filter(on).drop("_salt")


def filter_urls(captures: DataFrame, entries: DataFrame, small_list: int = SMALL_LIST) -> DataFrame:
    """captures (page_id, url, fetched_at) with host, n_block, n_allow, first_rule and blocked as of the fetch time."""
    base = captures.select("page_id", "url", "fetched_at", host_of(F.col("url")).alias("host"))
    keys = base.select("page_id", "url", "fetched_at", F.explode(rule_keys(F.col("host"), F.coalesce("url", F.lit("")))).alias("key"))
    active = active_rules(keys, validity_intervals(entries), small_list)
    rules = lambda kind: F.collect_set(F.when(F.col("list") == kind, F.col("key")))  # noqa: E731  a capture has few keys
    verdict = active.groupBy("page_id", "url", "fetched_at").agg(rules("block").alias("_b"), rules("allow").alias("_a"))
    v = verdict.select(*[F.col(c).alias(f"_{c}") for c in ("page_id", "url", "fetched_at")], F.size("_b").cast("long").alias("n_block"), F.size("_a").cast("long").alias("n_allow"), F.array_min("_b").alias("first_rule"))
    same = base.page_id.eqNullSafe(F.col("_page_id")) & base.url.eqNullSafe(F.col("_url")) & base.fetched_at.eqNullSafe(F.col("_fetched_at"))
    zero = F.lit(0).cast("long")
    out = base.join(v, same, "left").drop("_page_id", "_url", "_fetched_at").withColumns({"n_block": F.coalesce("n_block", zero), "n_allow": F.coalesce("n_allow", zero)})
    return out.withColumn("blocked", (F.col("n_block") > 0) & (F.col("n_allow") == 0))


def captures_of(pages: DataFrame) -> DataFrame:
    """Captures: page k was fetched on day k mod 366 of 2024."""
    day = F.pmod(F.col("page_id"), F.lit(366)).cast("int")
    return pages.select("page_id", "url", F.date_add(F.lit("2024-01-01").cast("date"), day).cast("timestamp").alias("fetched_at"))


def dated_entries(pages: DataFrame) -> DataFrame:
    """Dated list entries derived from the hosts that occur: by its MD5 a host, its parent domain or its /en section is listed, dropped and listed again."""
    hosts = pages.select(host_of(F.col("url")).alias("host")).filter("host <> ''").distinct()
    parent = F.regexp_replace("host", r"^[^.]+\.", "")
    h = F.conv(F.substring(F.md5("host"), 1, 6), 16, 10).cast("long")
    rows = hosts.withColumn("h", h).withColumn("parent", parent)
    day = lambda n: F.date_add(F.lit("2024-01-01").cast("date"), n.cast("int")).cast("timestamp")
    first, second, third = F.col("h") % 120, F.col("h") % 120 + 40 + F.col("h") % 50, F.col("h") % 120 + 120 + F.col("h") % 70
    entry = lambda kind, rule, action, at, where: F.when(where, F.struct(F.lit(kind).alias("list"), rule.alias("rule"), F.lit(action).alias("action"), day(at).alias("effective_at")))
    listed = [
        entry("block", F.col("host"), "add", first, F.col("h") % 3 == 0),
        entry("block", F.col("host"), "remove", second, F.col("h") % 3 == 0),
        entry("block", F.col("host"), "add", third, F.col("h") % 6 == 0),
        entry("block", F.col("parent"), "add", third, F.col("h") % 7 == 1),
        entry("block", F.concat("host", F.lit("/en")), "add", first, F.col("h") % 5 == 2),
        entry("allow", F.col("host"), "add", second, F.col("h") % 4 == 3),
    ]
    return rows.select(F.explode(F.array(*listed)).alias("e")).filter("e is not null").select("e.*")


def op1_temporal_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return filter_urls(captures_of(pages), dated_entries(pages)).select("page_id", "host", "fetched_at", "n_block", "n_allow", "first_rule", "blocked")


QUERIES = {"op1_temporal_url_filter": op1_temporal_url_filter}
ORACLES = {
    "op1_temporal_url_filter": r"""
WITH c AS (
  SELECT page_id, coalesce(url, '') AS url, TIMESTAMP '2024-01-01' + to_days((page_id % 366)::INT) AS fetched_at,
    regexp_replace(lower(regexp_extract(coalesce(url, ''), '^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1)), '^www\.|\.$', '', 'g') AS host FROM pages),
hosts AS (SELECT host, ('0x' || substr(md5(host), 1, 6))::BIGINT AS h, regexp_replace(host, '^[^.]+\.', '') AS parent FROM (SELECT DISTINCT host FROM c WHERE host <> '')),
t AS (SELECT *, h % 120 AS d1, h % 120 + 40 + h % 50 AS d2, h % 120 + 120 + h % 70 AS d3 FROM hosts),
e AS (
  SELECT 'block' AS list, host AS rule, 'add' AS action, d1 AS d FROM t WHERE h % 3 = 0
  UNION ALL SELECT 'block', host, 'remove', d2 FROM t WHERE h % 3 = 0
  UNION ALL SELECT 'block', host, 'add', d3 FROM t WHERE h % 6 = 0
  UNION ALL SELECT 'block', parent, 'add', d3 FROM t WHERE h % 7 = 1
  UNION ALL SELECT 'block', host || '/en', 'add', d1 FROM t WHERE h % 5 = 2
  UNION ALL SELECT 'allow', host, 'add', d2 FROM t WHERE h % 4 = 3),
ed AS (SELECT list, rule, TIMESTAMP '2024-01-01' + to_days(d::INT) AS since, max(action) AS action FROM e GROUP BY ALL),
k AS (
  SELECT page_id, fetched_at, host || '/' || regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*/([^/?#]+)', 1) AS rule FROM c WHERE host <> ''
  UNION SELECT page_id, fetched_at, array_to_string(l[i:], '.') FROM (SELECT page_id, fetched_at, string_split(host, '.') AS l, unnest(range(1, len(string_split(host, '.')) + 1)) AS i FROM c WHERE host <> '')),
latest AS (SELECT page_id, list, rule, arg_max(action, since) AS action FROM k JOIN ed USING (rule) WHERE since <= fetched_at GROUP BY ALL),
v AS (SELECT page_id, count(*) FILTER (list = 'block') AS n_block, count(*) FILTER (list = 'allow') AS n_allow, min(rule) FILTER (list = 'block') AS first_rule FROM latest WHERE action = 'add' GROUP BY page_id)
SELECT c.page_id, host, fetched_at, coalesce(n_block, 0) AS n_block, coalesce(n_allow, 0) AS n_allow, first_rule,
  coalesce(n_block, 0) > 0 AND coalesce(n_allow, 0) = 0 AS blocked
FROM c LEFT JOIN v ON v.page_id = c.page_id"""
}
