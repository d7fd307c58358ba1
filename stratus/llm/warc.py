r"""WARC archives: writing with revisits, reading by boundary chains (operator 3).

Writing: the least page of each payload digest gets a response record, the
others a revisit record that refers to it. Files are written by Spark, one
record a row, so any shared store will do.

Reading: Spark splits the files at ``\r\n\r\nWARC/1.1\r\n``. Every piece is a
candidate record, as is every such string inside a payload. From the running
length of the pieces follows a candidate's offset, from its Content-Length the
offset of its successor. Pointer jumping from offset 0 of every file (block by block, each
round doubles the steps) marks the records that a reader would reach; all
other candidates belong to the payload of the record before them.

Payloads are not shuffled to be read: a record within one piece is digested
where it is read, only records cut by a magic string inside are put together.

Cases: a null html is an empty payload; page ids may be null or repeated (rows
with the least id of a payload are all responses); carriage returns and line
feeds in a url are percent-encoded; a file that does not start with a record
has none; an empty table gives no records; extra columns are ignored.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratus.llm.common import Rounds, written
from stratus.operators.joins import bounded
from stratus.session import scratch_dir

# Fixed values of the format.
MAGIC = "WARC/1.1\r\n"
CRLF = "\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
# Bytes of a file whose chains one task follows.
BLOCK_BYTES = 4 * 1024 * 1024
# Bytes of revisits that are broadcast (as JSON, an upper bound).
MOST_BROADCAST = 64 * 1024 * 1024


def base32_sha1(data: Column) -> Column:
    """Bare upper-case base32 SHA-1 of a binary column."""
    digits = F.sha1(data)
    parts = [F.lpad(F.conv(F.substring(digits, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.upper(F.concat(*parts)), "0123456789ABCDEFGHIJKLMNOPQRSTUV",
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _revisits(pages: DataFrame, least_bytes: int) -> DataFrame:
    """(page, digest, first) of the pages whose payload a page with a smaller id has already.

    From one pass over the bodies that keeps only their sizes and digests.
    """
    body = F.coalesce("html", F.lit(""))
    known = written(pages.select("page_id", F.octet_length(body).alias("size"),
                                 base32_sha1(body.cast("binary")).alias("digest")), "digests")
    known = known.where(F.col("size") >= least_bytes)
    first = (known.groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
                  .where((F.col("n") > 1) & F.col("first").isNotNull()))
    return written(known.join(first.hint("merge"), "digest").where(~F.col("page_id").eqNullSafe(F.col("first"))).select(
        F.col("page_id").alias("page"), F.col("digest").alias("own"), "first").distinct(), "revisits")


def _records(pages: DataFrame, least_bytes: int) -> DataFrame:
    """One column: the records of ``pages`` as text, without their last line end.

    The revisits are broadcast if they pass the size check, so that no body is
    shuffled; beyond it bodies and revisits are joined by shuffling both.
    """
    rows = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"),
                        F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("digest", base32_sha1(F.col("html").cast("binary")))
    again = bounded(_revisits(pages, least_bytes), MOST_BROADCAST)
    rows = rows.join(again, F.col("page_id").eqNullSafe(F.col("page")) & (F.col("digest") == F.col("own")), "left")
    revisit = F.col("first").isNotNull()
    url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    page = F.coalesce(F.col("page_id").cast("string"), F.lit("null"))
    header = F.concat(
        F.lit(MAGIC), F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response"), F.lit(CRLF),
        F.lit("WARC-Record-ID: <urn:page:"), page, F.lit(">" + CRLF),
        F.lit("WARC-Target-URI: "), url, F.lit(f"{CRLF}WARC-Date: {DATE}{CRLF}"),
        F.lit("WARC-Payload-Digest: sha1:"), F.col("digest"), F.lit(CRLF),
        F.when(revisit, F.concat(F.lit(f"WARC-Profile: {REVISIT_PROFILE}{CRLF}WARC-Refers-To: <urn:page:"),
                                 F.col("first").cast("string"), F.lit(">" + CRLF))).otherwise(""),
        F.lit(f"Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.when(revisit, 0).otherwise(F.octet_length("html")).cast("string"), F.lit(CRLF + CRLF))
    return rows.select(F.concat(header, F.when(revisit, "").otherwise(F.col("html")), F.lit(CRLF)).alias("value"))


def write_archives(pages: DataFrame, path: str, least_bytes: int = 0) -> None:
    """WARC files of ``pages`` (page_id, url, html) under ``path``."""
    _records(pages, least_bytes).write.option("lineSep", CRLF).text(path)


def _header(name: str) -> Column:
    return F.regexp_extract("header", rf"(?i)(?:^|\r\n){name}:[ \t]*([^\r\n]*)", 1)


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, row, heads, starts, shift, body): what lies between the magic strings, in reading order.

    ``block`` and ``row`` follow the splits of this very scan; another scan may
    be split otherwise, so they are used within one job only.

    A piece of a file's first block that begins with a magic (``heads``) is the
    file's first one, without a magic before it, or follows a doubled magic.
    It comes both ways: whole, and (``starts``) from behind its own magic.

    A magic string may begin with the last line end of another one. The reader
    finds the first of the two; the second begins the next piece, which then
    comes twice: whole, and (``shift`` > 0) from behind that magic.
    """
    read = spark.read.option("lineSep", CRLF + CRLF + MAGIC).text(path)
    heads = F.col("value").startswith(MAGIC) & (F.col("_metadata.file_block_start") == 0)
    ways = F.when(F.col("heads"), F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    rows = read.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"), heads.alias("heads"), F.col("value").cast("binary").alias("body"))
    rows = rows.withColumn("starts", F.explode(ways)).withColumn(
        "body", F.when(F.col("starts"), _from(F.col("body"), len(MAGIC))).otherwise(F.col("body")))
    twice = F.col("body").cast("string").startswith(CRLF + MAGIC)
    shifts = F.when(twice, F.array(F.lit(0), F.lit(len(CRLF + MAGIC)))).otherwise(F.array(F.lit(0)))
    return rows.withColumn("shift", F.explode(shifts)).withColumn("body", _from(F.col("body"), F.col("shift")))


def _from(data: Column, skip: Column | int) -> Column:
    """Binary ``data`` without its first ``skip`` bytes."""
    skip = F.lit(skip) if isinstance(skip, int) else skip
    return F.substring(data, skip + 1, F.lit(2**31 - 1))


def candidates(found: DataFrame) -> DataFrame:
    """Offset, successor, headers and content hash of every piece of ``pieces``, without the bodies.

    Offsets are running sums within a split, on top of the sums of the splits before it.
    """
    # a header's blank line may be the beginning of the magic string that ends its piece
    rows = found.select("file", "block", "row", "heads", "starts", "shift", F.octet_length("body").alias("size"), "body",
                        F.substring_index(F.col("body").cast("string"), CRLF + CRLF, 1).alias("header"))
    rows = rows.withColumn("length", F.try_to_number(F.regexp_extract(
        "header", r"(?i)(?:^|\r\n)Content-Length:[ \t]*([0-9]{1,15})[ \t]*(?:\r\n|$)", 1),
        F.lit("999999999999999")).cast("long"))
    start = F.octet_length("header") + 4
    whole = F.substring(F.col("body"), start + 1, F.col("length").cast("int"))
    inside = F.col("size") >= start + F.col("length")
    rows = rows.select("file", "block", "row", "heads", "starts", "shift", "size", "length", start.alias("start"), inside.alias("inside"),
                       _content("body").alias("content"),
                       F.when(inside, base32_sha1(whole)).alias("digest"),
                       _header("WARC-Type").alias("record_type"),
                       F.regexp_extract(_header("WARC-Record-ID"), "<urn:page:(.*)>", 1).alias("page_id"),
                       F.regexp_extract(_header("WARC-Refers-To"), "<urn:page:(.*)>", 1).alias("refers_to"),
                       F.regexp_replace(_header("WARC-Payload-Digest"), "^sha1:", "").alias("declared"))
    # only a file's first piece begins behind its own magic
    order = Window.partitionBy("file", "block").orderBy("row", "shift")
    leads = (F.col("block") == 0) & (F.first("row").over(order) == F.col("row"))
    rows = rows.withColumn("leads", leads).where(~F.col("heads") | (F.col("starts") == F.col("leads")))
    # bytes before a piece's magic: the pieces before it, each with its magic and the blank line after it
    whole_piece = F.when(F.col("shift") == 0, F.col("size") + len(MAGIC) + 4).otherwise(0)
    rows = written(rows.withColumn("within", F.sum(whole_piece).over(order) - whole_piece)
                       .withColumn("bytes", whole_piece), "pieces")
    splits = rows.groupBy("file", "block").agg(F.sum("bytes").alias("sum"))
    earlier = Window.partitionBy("file").orderBy("block")            # one row a split
    splits = splits.select("file", "block", (F.sum("sum").over(earlier) - F.col("sum")).alias("ahead"))
    rows = rows.join(splits, ["file", "block"])
    passed = F.col("ahead") + F.col("within")
    # the second magic of a piece stands in the piece itself, behind a line end
    offset = F.when(F.col("shift") == 0, passed).otherwise(
        passed - 4 - F.col("size") - F.col("shift") + len(CRLF))
    return rows.withColumn("offset", offset).withColumn(
        "next", F.col("offset") + len(MAGIC) + F.col("start") + F.col("length") + 4).drop(
        "block", "row", "within", "bytes", "ahead")


def _content(body: str) -> Column:
    """What tells the bodies of pieces apart, in any scan."""
    return F.struct(F.octet_length(body).alias("size"), F.xxhash64(body).alias("a"), F.hash(body).alias("b"))


_LINK = "file string, block long, offset long, next long"


def _skip_block(rows: pd.DataFrame) -> pd.DataFrame:
    """Where each candidate's chain leaves its block (``beyond``); successors lie behind, so from the end."""
    beyond = {}
    for offset, follower in sorted(zip(rows["offset"], rows["next"]), reverse=True):
        beyond[offset] = beyond.get(follower, follower)
    return rows.assign(beyond=[beyond[x] for x in rows["offset"]])


def _walk_block(rows: pd.DataFrame) -> pd.DataFrame:
    """The candidates of a block on the chain from its ``entered`` ones."""
    followers = dict(zip(rows["offset"], rows["next"]))
    on = set()
    for at in rows.loc[rows["entered"], "offset"]:
        while at in followers and at not in on:
            on.add(at)
            at = followers[at]
    return rows.loc[rows["offset"].isin(on), ["file", "offset"]]


def reachable(links: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(file, offset) reached from offset 0 by ``links`` (file, offset, next), by pointer jumping.

    Tasks first follow the chains inside blocks of ``block_bytes`` of a file,
    so that the jumps go from block to block: their number is the logarithm of
    a file's blocks, not of its records.
    """
    blocks = links.select("file", (F.col("offset") / block_bytes).cast("long").alias("block"), "offset",
                          F.coalesce("next", F.lit(-1).cast("long")).alias("next"))
    skipped = written(blocks.groupBy("file", "block").applyInPandas(
        _skip_block, _LINK + ", beyond long"), "links")
    there = skipped.select("file", F.col("offset").alias("beyond"))
    jumps, fronts = Rounds("jumps"), Rounds("reached")
    jump = jumps.write(skipped.select("file", "offset", "beyond").join(there, ["file", "beyond"]))
    reached = fronts.write(skipped.where("offset = 0").select("file", "offset"))
    seen = reached.count()
    while True:
        ahead = reached.join(jump, ["file", "offset"]).select("file", F.col("beyond").alias("offset"))
        reached = fronts.write(reached.union(ahead).distinct())
        now = reached.count()
        if now == seen:
            break
        seen = now
        further = jump.select("file", F.col("offset").alias("beyond"), F.col("beyond").alias("top"))
        jump = jumps.write(jump.join(further, ["file", "beyond"]).select(
            "file", "offset", F.col("top").alias("beyond")))
    entered = skipped.join(reached.withColumn("entered", F.lit(True)), ["file", "offset"], "left")
    return entered.select("file", "block", "offset", "next", F.coalesce(
        "entered", F.lit(False)).alias("entered")).groupBy("file", "block").applyInPandas(
        _walk_block, "file string, offset long")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """file, offset, page_id (string), record_type, refers_to, declared, payload_bytes, payload_digest.

    The digest is that of the bytes read; a revisit has none of its own. A
    response whose digest is not the declared one stops the job that reads it.
    """
    table = written(candidates(pieces(spark, path)), "candidates")
    records = table.where((F.col("offset") > 0) | F.col("starts"))
    roots = written(reachable(records.select("file", "offset", "next")), "reached")
    # key tables grow with the records: joined by shuffling, whatever their size
    marked = written(table.join(roots.withColumn("reached", F.lit(True)).hint("merge"), ["file", "offset"], "left"),
                     "marked")
    records = marked.where("reached")
    put_together = _cut_payloads(spark, path, marked)
    found = (records.join(put_together, ["file", "offset"], "left")
                    .select("file", "offset", "page_id", "record_type", "refers_to", "declared",
                            F.col("length").alias("payload_bytes"),
                            F.coalesce("digest", "joined_digest").alias("payload_digest")))
    wrong = (F.col("record_type") == "response") & ~F.col("payload_digest").eqNullSafe(F.col("declared"))
    return found.withColumn("payload_digest", F.when(wrong, F.raise_error(F.concat(
        F.lit("the payload at "), "file", F.lit(" "), F.col("offset").cast("string"),
        F.lit(" is not the declared one")))).otherwise(F.col("payload_digest")))


def _cut_payloads(spark: SparkSession, path: str, marked: DataFrame) -> DataFrame:
    """(file, offset, joined_digest) of the reached records that magic strings in their payload cut up.

    A record's pieces are those between its offset and its successor's, found
    by blocks of the file. Their bodies come from a second scan by content, not
    by place, as that scan may be split otherwise; as a rule they are few, and
    a small table spares the bodies the shuffle.
    """
    block = F.lit(BLOCK_BYTES)
    cut = marked.where(F.col("reached") & ~F.col("inside")).select(
        "file", F.col("offset").alias("owner"), F.col("next").alias("end"), F.col("start").alias("from"),
        F.col("length").alias("bytes"))
    # a length beyond the end of its file ends with it
    last = marked.groupBy("file").agg(F.max("offset").alias("last"))
    cut = cut.join(last, "file").withColumn("place", F.explode(F.sequence(
        (F.col("owner") / block).cast("long"), (F.least("end", "last") / block).cast("long")))).drop("last")
    # of a piece that comes twice only the record's own is cut
    owned = marked.where((F.col("shift") == 0) | F.col("reached")).select(
        "file", "offset", "content", (F.col("offset") / block).cast("long").alias("place"))
    parts = written(owned.join(cut, ["file", "place"]).where(
        (F.col("offset") >= F.col("owner")) & (F.col("offset") < F.col("end"))), "parts")
    wanted = parts.select("content").distinct()
    bodies = (pieces(spark, path).select(_content("body").alias("content"), "body")
              .join(bounded(wanted), "content").groupBy("content").agg(F.first("body").alias("body")))
    joint = F.lit(CRLF + CRLF + MAGIC).cast("binary")
    joined = F.aggregate(F.slice("all", F.lit(2), F.size("all")), F.col("all")[0]["body"],
                         lambda text, x: F.concat(text, joint, x["body"]))
    whole = (parts.join(bodies, "content").groupBy("file", "owner")
                  .agg(F.first("from").alias("from"), F.first("bytes").alias("bytes"),
                       F.sort_array(F.collect_list(F.struct("offset", "body"))).alias("all")))
    return whole.select("file", F.col("owner").alias("offset"), base32_sha1(
        F.substring(joined, F.col("from") + 1, F.least(F.col("bytes"), F.lit(2**31 - 1)).cast("int"))).alias("joined_digest"))


def round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every page, from its archives."""
    spark, kind = pages.sparkSession, pages.schema["page_id"].dataType
    path = scratch_dir(spark, "warc")
    write_archives(pages, path, least_bytes)
    records = written(read_archives(spark, path), "records")
    n_read, n_written = records.count(), pages.count()
    if n_read != n_written:
        raise ValueError(f"{n_read} records read of {n_written} written")
    responses = (records.where("record_type = 'response'").groupBy(
        F.col("page_id").alias("refers_to"), F.col("payload_digest").alias("declared"))
        .agg(F.first("payload_bytes").alias("response_bytes")).hint("merge"))
    revisits = records.where("record_type = 'revisit'").join(responses, ["refers_to", "declared"], "left")
    number = lambda c: F.when(F.col(c) != "null", F.col(c)).cast(kind)
    return (records.where("record_type = 'response'").select(
                number("page_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                F.lit(None).cast(kind).alias("refers_to"))
            .union(revisits.select(number("page_id"), "response_bytes", "declared", "record_type",
                                   number("refers_to"))))


def _base32_sql(digits: str) -> str:
    """DuckDB: 40 hexadecimal digits in base32, eight characters from ten digits."""
    return " || ".join(
        f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', "
        f"(((('0x' || substr({digits}, {1 + 10 * part}, 10))::BIGINT >> {shift}) & 31) + 1)::INT, 1)"
        for part in range(4) for shift in range(35, -1, -5))


ORACLE_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
q AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS digits,
             min(page_id) OVER (PARTITION BY html) AS response FROM p)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, {_base32_sql('digits')} AS payload_digest,
       CASE WHEN page_id = response OR response IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM response THEN response END AS refers_to
FROM q
"""
