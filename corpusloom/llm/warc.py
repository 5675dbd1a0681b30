"""WARC archives: written from page rows, read back by boundary-chain verification.

Writing: each page becomes one record; of pages with equal payloads of at
least ``min_revisit`` bytes the largest page_id is a response and the others
revisit it.  Spark's text writer puts the records into files, with the
record terminator as line separator.

Reading: Spark's text reader cuts the archives at every line that is the record
magic, so plain files are read in byte ranges by several tasks and gzipped ones
are streamed; no task holds a file.  Each piece tells its length, from which
its offset follows, and what a record that began there would be: a candidate
(offset, offset of its successor by Content-Length).  The magic may also occur
inside a payload, so candidates prove nothing by themselves: pointer jumping
from offset 0 doubles the known chain each round, and only candidates that are
reached are records.  A record of one piece is hashed as it is read; the pieces
of one with magic in its payload are put together once the chain is known.

Defined edge cases: a null html is an empty payload; a null page_id is kept as
null; a null url is an empty target; line breaks in a url become spaces; rows
that repeat a page_id with the same large payload are all responses if it is
the largest id; the magic inside a header line or a payload begins no record; a
record ends where a further magic or the end of the file follows its
terminator, so a file that ends inside a record loses that record only, and one
that is broken in its middle ends there; no pages give no archives and no rows;
extra columns of the pages, whatever their names, are not written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import materialize, new_path, table

MAGIC = "WARC/1.1\r\n"
CUT = "\r\n" + MAGIC  # what separates pieces: the magic on a line of its own
END = "\r\n\r\n"
RECORDS_PER_FILE = 16_384
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def records(pages: DataFrame, min_revisit: int = 1000, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """(value): the text of one WARC record per page, without its terminator."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    base = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.regexp_replace(F.coalesce(F.col("url").cast("string"), F.lit("")), "[\r\n]", " ").alias("url"),
        html.alias("html"),
        F.octet_length(html).cast("long").alias("n"),
        F.sha1(html.cast("binary")).alias("digest"),
    )
    copies = base.select("digest", "n", "page_id").filter(F.col("n") >= min_revisit).groupBy("digest")
    copies = copies.agg(F.max("page_id").alias("kept"), F.count(F.lit(1)).alias("c")).filter("c > 1").select("digest", "kept")
    joined = base.join(copies, "digest", "left")
    revisit = F.col("kept").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("kept"))
    block = F.when(revisit, F.lit("")).otherwise(F.concat(F.lit(HTTP_HEAD), F.col("html")))

    def line(name: str, value) -> list:
        return [F.lit(f"{name}: "), value, F.lit("\r\n")]

    def urn(page):
        return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("null")), F.lit(">"))

    head = F.concat(
        F.lit(MAGIC),
        *line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        *line("WARC-Record-ID", urn(F.col("page_id"))),
        *line("WARC-Date", F.lit(date)),
        *line("WARC-Target-URI", F.col("url")),
        *line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(revisit, F.concat(*line("WARC-Profile", F.lit(PROFILE)), *line("WARC-Refers-To", urn(F.col("kept"))))).otherwise(F.lit("")),
        *line("WARC-Payload-Length", F.col("n").cast("string")),
        *line("Content-Type", F.lit("application/http; msgtype=response")),
        *line("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
    )
    return joined.select(F.concat(head, block).alias("value"))


def write_archives(pages: DataFrame, path: str, records_per_file: int = RECORDS_PER_FILE, compression: str = "gzip", **options) -> None:
    """Write the pages as WARC files of at most ``records_per_file`` records; with compression "none" they can be read in byte ranges."""
    out = records(pages, **options).write.option("lineSep", END).option("maxRecordsPerFile", records_per_file)
    out.option("compression", compression).text(path)


def _before(text: Column, mark: str) -> Column:
    """Number of bytes before the first ``mark``, all of them if there is none."""
    return F.octet_length(F.substring_index(text, mark, 1)).cast("long")


def _slice(text: Column, at: Column, n: Column) -> Column:
    """n bytes from the 0-based offset ``at``, as a string that may hold any bytes."""
    return F.substring(text.cast("binary"), (at + 1).cast("int"), n.cast("int")).cast("string")


def _field(head: Column, name: str) -> Column:
    """The value of the first header line of that name, null if there is none."""
    value = F.regexp_extract(head, rf"(?i)(?:^|\r\n){name}[ \t]*:[ \t]*([^\r\n]*)", 1)
    return F.when(head.rlike(rf"(?i)(?:^|\r\n){name}[ \t]*:"), F.trim(value))


def _page(value: Column) -> Column:
    return F.regexp_extract(value, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")


def _payload(text: Column) -> Column:
    """(size, digest) of the payload of the record that begins with ``text``; needs its body_at and length."""
    body = _slice(text, F.col("body_at"), F.col("length"))
    http = _before(body, END)
    at = F.when(http < F.col("length"), http + len(END)).otherwise(F.lit(0))
    payload = _slice(body, at, F.col("length") - at)
    return F.struct(F.octet_length(payload).cast("long").alias("size"), F.sha1(payload.cast("binary")).alias("digest"))


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """The archives cut at each magic, and of each piece what its head says: file, block, mid, n, length, body_at, ..., own, text.

    Order inside a file is (block, mid): where the byte range begins and the row of the task that read it.
    """
    read = spark.read.option("lineSep", CUT).text(path)
    cut = read.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("mid"),
        F.col("value").alias("text"),
        F.octet_length("value").cast("long").alias("n"),
        F.when(F.startswith("value", F.lit(MAGIC)), len(MAGIC)).otherwise(0).cast("long").alias("skip"),  # the first piece of a file
    )
    cut = cut.withColumn("rest", F.when(F.col("skip") > 0, _slice(F.col("text"), F.col("skip"), F.col("n") - F.col("skip"))).otherwise(F.col("text")))
    cut = cut.withColumn("head", F.substring_index("rest", END, 1)).withColumn("body_at", F.col("skip") + F.octet_length("head") + len(END)).drop("rest")
    length = _field(F.col("head"), "content-length")
    length = F.when(F.col("body_at") <= F.col("n"), F.when(length.rlike(r"^\d+$"), length.try_cast("long")))  # a head without end tells nothing
    told = cut.withColumn("length", length)
    told = told.withColumn("past", F.col("n") - F.col("body_at") - F.col("length"))  # bytes of the piece after the body
    names = {"id": "warc-record-id", "url": "warc-target-uri", "kind": "warc-type", "refers": "warc-refers-to", "declared": "warc-payload-digest", "size": "warc-payload-length"}
    for name, header in names.items():
        told = told.withColumn(name, _field(F.col("head"), header))
    own = F.when((F.col("past") >= 0) & (F.col("kind") == "response"), _payload(F.col("text")))
    told = told.withColumn("own", own).withColumn("blank2", F.endswith("text", F.lit("\r\n"))).withColumn("blank4", F.endswith("text", F.lit(END)))
    return told.drop("head")


def candidates(cut: DataFrame) -> DataFrame:
    """Pieces at which a whole record would begin, with start, succ and whether it goes on in later pieces (open)."""
    order = Window.partitionBy("file").orderBy("block", "mid")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    placed = cut.withColumn("at", F.coalesce(F.sum(F.col("n") + len(CUT)).over(before), F.lit(0)))
    placed = placed.withColumn("led", F.lag("blank2").over(order)).withColumn("last", F.lead("n").over(order).isNull())
    first = F.col("led").isNull()
    start = F.when(first, F.lit(0)).otherwise(F.col("at") - len(MAGIC)).cast("long")
    placed = placed.withColumn("start", start).withColumn("led", F.when(first, F.col("skip") > 0).otherwise(F.col("led") & (F.col("skip") == 0)))
    placed = placed.withColumn("succ", F.col("at") + F.col("body_at") + F.col("length") + len(END)).withColumn("end", F.when(F.col("last"), F.col("at") + F.col("n")))
    ends = placed.filter("led").select("file", F.col("start").alias("succ")).union(placed.filter("last and blank4").select("file", "end"))
    heads = placed.filter("led and length is not null and kind is not null").withColumn("open", F.expr("past < 2 and not last"))
    single = heads.filter("not open and (past = 2 and blank2 and not last or past = 4 and blank4 and last)")
    return single.unionByName(heads.filter("open").join(ends.hint("merge"), ["file", "succ"], "left_semi").select(*single.columns))


def reachable(links: DataFrame) -> DataFrame:
    """(file, start) of the candidates on the chain from offset 0; links: file, start, succ."""
    jump = links.select("file", "start", "succ")
    known = materialize(links.filter("start = 0").select("file", "start"), "reach")
    count = known.count()
    while True:
        step = known.join(jump.hint("merge"), ["file", "start"]).select("file", F.col("succ").alias("start"))
        step = step.join(links.select("file", "start").hint("merge"), ["file", "start"], "left_semi")
        known = materialize(known.union(step).distinct(), "reach")
        new = known.count()
        if new == count:
            return known
        count = new
        second = jump.select("file", F.col("start").alias("succ"), F.col("succ").alias("_to"))
        jump = materialize(jump.join(second.hint("merge"), ["file", "succ"]).select("file", "start", F.col("_to").alias("succ")), "jump")


def payloads_of(records: DataFrame, places: DataFrame, cut: DataFrame) -> DataFrame:
    """(file, start, own) of the records that take several pieces; places: the start of every piece, key: file, block, mid."""
    marks = places.join(records.select("file", "start", F.col("start").alias("_record")).hint("merge"), ["file", "start"], "left")
    owner = F.last("_record", ignorenulls=True).over(Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, 0))
    owned = marks.select("file", "block", "mid", F.col("start").alias("at"), owner.alias("start"))
    owned = owned.join(records.filter("open").select("file", "start", "succ", "body_at", "length").hint("merge"), ["file", "start"]).filter(F.col("at") < F.col("succ"))
    parts = owned.join(cut.select("file", "block", "mid", "text").hint("merge"), ["file", "block", "mid"])
    whole = parts.groupBy("file", "start", "body_at", "length").agg(F.array_sort(F.collect_list(F.struct("at", "text"))).alias("parts"))  # one record
    return whole.withColumn("text", F.array_join("parts.text", CUT)).select("file", "start", _payload(F.col("text")).alias("_own"))


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The records of the archives under ``path``: page_id, url, record_type, refers_to, payload_bytes, payload_digest, digest_ok."""
    cut = materialize(pieces(spark, path), "warc-cut")
    found = materialize(candidates(cut.drop("text")), "warc-cand")
    chain = reachable(found.select("file", "start", "succ"))
    kept = materialize(found.join(chain.hint("merge"), ["file", "start"], "left_semi"), "warc-kept")
    if not kept.filter("open and kind = 'response'").isEmpty():
        order = Window.partitionBy("file").orderBy("block", "mid").rowsBetween(Window.unboundedPreceding, -1)
        at = F.sum(F.col("n") + len(CUT)).over(order) - len(MAGIC)
        places = cut.select("file", "block", "mid", "n").withColumn("start", F.coalesce(at, F.lit(0))).drop("n")
        kept = kept.join(payloads_of(kept, places, cut).hint("merge"), ["file", "start"], "left").withColumn("own", F.coalesce("own", "_own"))
    response = F.col("kind") == "response"
    declared = F.regexp_replace("declared", "^sha1:", "")
    return kept.select(
        _page(F.col("id")).alias("page_id"),
        "url",
        F.col("kind").alias("record_type"),
        _page(F.col("refers")).alias("refers_to"),
        F.when(response, F.col("own.size")).otherwise(F.col("size").try_cast("long")).alias("payload_bytes"),
        F.when(response, F.col("own.digest")).otherwise(declared).alias("payload_digest"),
        F.when(response, F.col("own.digest") == declared).otherwise(F.lit(True)).alias("digest_ok"),
    )


def op8_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), path)
    return read_archives(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "digest_ok")


QUERIES = {"op8_warc_round_trip": op8_warc_round_trip}
ORACLES = {
    "op8_warc_round_trip": """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS d FROM pages),
g AS (SELECT d, max(page_id) AS kept, count(*) AS c FROM p WHERE n >= 1000 GROUP BY d)
SELECT page_id, n::BIGINT AS payload_bytes, p.d AS payload_digest,
  CASE WHEN g.c > 1 AND page_id <> kept THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN g.c > 1 AND page_id <> kept THEN kept END AS refers_to, true AS digest_ok
FROM p LEFT JOIN g ON p.d = g.d"""
}
