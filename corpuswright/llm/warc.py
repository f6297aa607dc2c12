"""WARC archives written and read by Spark, records found by boundary chains.

Writing: one text row per record (headers, blank line, block); the writer's line separator is the blank
lines that end a WARC record, so each part file is a plain WARC file. Repeated payloads become revisit
records that refer to the response with the smallest page id.

Reading: the magic line is the separator of Spark's text reader, so files of any size are split by byte
ranges and read in parallel. Every piece between two magics is a candidate record with a start offset and,
from its Content-Length, a successor offset. A payload may hold the magic itself, so candidates are only
believed if the chain of successors that starts at offset 0 of the file reaches them. Pointer jumping finds
those in as many rounds as the longest chain has binary digits. Pieces that are not reached belong
to the payload of the record before them. Texts that are needed after that are read again and known by their digest,
not by a number of their row: how files are split for reading may change between two scans.

Defined results: null html is an empty payload; rows with equal page id and payload become equal records, all of
them response if they hold the smallest id; a null page id comes last and is written as an empty id; control
characters of a url are percent-encoded; a file that does not start with the magic, or whose chain
breaks, gives the records up to the break; an empty table gives no records.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpuswright.session import broadcast_if_small, cut_lineage, release, shared_dir

MAGIC = "WARC/1.1\r\n"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def dedupe_payloads(pages: DataFrame, *, page_id: str = "page_id", url: str = "url", html: str = "html", min_bytes: int = 100) -> DataFrame:
    """Columns page_id, url, payload, payload_bytes, payload_digest, refers_to (null for a response).

    The smallest id of each digest is found with map-side combine. Only digests that occur more than once are
    joined back: as a broadcast up to a counted 200,000 of them (some 20 MB), so payloads stay where they are, and by a
    shuffle beyond, in which Spark can split the rows of a frequent digest.
    """
    payload = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(
        F.col(page_id).alias("page_id"),
        F.coalesce(F.col(url), F.lit("")).alias("url"),
        payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        F.sha2(payload.cast("binary"), 256).alias("payload_digest"),
    )
    repeated = (
        rows.where(F.col("payload_bytes") >= min_bytes)
        .groupBy("payload_digest")
        .agg(F.count(F.lit(1)).alias("n"), F.min("page_id").alias("first_id"))
        .where("n > 1 and first_id is not null")
        .select("payload_digest", "first_id")
    )
    repeated = broadcast_if_small(cut_lineage(repeated), max_rows=200_000)
    return rows.join(repeated, "payload_digest", "left").select(
        "page_id", "url", "payload", "payload_bytes", "payload_digest",
        F.when(~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id")).alias("refers_to"),
    )


def record_text(date: str = "2024-01-01T00:00:00Z") -> Column:
    """A record without its closing blank lines, from the columns of ``dedupe_payloads``."""
    revisit = F.col("refers_to").isNotNull()
    block = F.when(revisit, F.lit("")).otherwise(F.concat(F.lit(HTTP), F.col("payload")))
    number = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    clean = F.regexp_replace("url", r"[\x00-\x20\x7f]", "%20")
    return F.concat(
        F.lit(MAGIC),
        F.lit("WARC-Type: "), F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
        F.lit("\r\nWARC-Record-ID: <urn:page:"), number(F.col("page_id")),
        F.lit(f">\r\nWARC-Date: {date}\r\nWARC-Target-URI: "), clean,
        F.lit("\r\nWARC-Payload-Digest: sha256:"), F.col("payload_digest"),
        F.lit("\r\nWARC-Payload-Length: "), number(F.col("payload_bytes")),
        F.when(revisit, F.concat(F.lit(f"\r\nWARC-Profile: {PROFILE}\r\nWARC-Refers-To: <urn:page:"), number(F.col("refers_to")), F.lit(">"))).otherwise(F.lit("")),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length(block).cast("string"),
        F.lit(END), block,
    )


def write_archives(deduped: DataFrame, folder: str, *, records_per_file: int = 20_000) -> None:
    """One WARC file per part file under ``folder``, which must be reachable from every executor."""
    deduped.select(record_text().alias("value")).write.option("lineSep", END).option("maxRecordsPerFile", records_per_file).text(folder)


def _fields(value: Column, head: Column) -> dict[str, Column]:
    """Where the block of a record lies in ``value`` (the text after the magic) and what its payload is."""
    length = F.regexp_extract(head, r"(?i)(?:^|\r\n)Content-Length:[ \t]*([0-9]{1,18})(?=\r\n|$)", 1).try_cast("long")
    skip = F.octet_length(head) + len(END)
    http = F.substring_index(F.substr(value, F.length(head) + len(END) + 1), END, 1)
    from_payload = skip + F.octet_length(http) + len(END)
    payload = F.substr(value.cast("binary"), (from_payload + 1).cast("int"), (skip + length - from_payload).cast("int"))
    response = F.regexp_extract(head, r"(?i)(?:^|\r\n)WARC-Type:[ \t]*([a-z]+)", 1) == "response"
    return {"reach": len(MAGIC) + skip + length + len(END), "fits": F.octet_length(value) >= skip + length, "payload": F.when(response, payload)}


def scan_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """place, file, block and value of the pieces between magics. ``place`` orders the pieces of one scan only."""
    raw = spark.read.option("lineSep", MAGIC).text(folder)
    return raw.select(F.monotonically_increasing_id().alias("place"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def text_key(value: Column) -> Column:
    return F.md5(value.cast("binary"))


def parse_pieces(pieces: DataFrame) -> DataFrame:
    """Cut table: place, file, block, size and the parsed headers of each piece, without its text.

    Digests of payloads, and of whole pieces by which their text is found again, are taken here, in the scan, so nothing
    after it moves or stores a payload.
    """
    value = F.col("value")
    rows = pieces.withColumn("head", F.when(F.instr(value, END) > 0, F.substring_index(value, END, 1)))
    f = _fields(value, F.col("head"))
    size = (F.octet_length(value) + len(MAGIC)).cast("long")
    return cut_lineage(
        rows.select("place", "file", "block", "head", size.alias("size"), f["reach"].alias("reach"), f["fits"].alias("fits"), F.octet_length(f["payload"]).alias("length"), F.sha2(f["payload"], 256).alias("digest"), text_key(value).alias("text_key"))
    )


def candidates(pieces: DataFrame) -> DataFrame:
    """Candidate records: place, file, start, next (null if the headers are broken), head, fits, length, digest, text_key.

    Offsets are exact: the text before a file's first magic and all pieces, each with its separator,
    add up to the file. Sums per read range (a few rows per file) give each range its first offset.
    """
    blocks = pieces.groupBy("file", "block").agg(F.sum("size").alias("bytes"))
    before = F.sum("bytes").over(Window.partitionBy("file").orderBy("block")) - F.col("bytes")
    blocks = blocks.select("file", "block", before.alias("base"))
    inside = F.sum("size").over(Window.partitionBy("file", "block").orderBy("place")) - F.col("size")
    # the first piece of a file precedes its first magic; the offset after it is that of the first record
    at = F.col("base") + F.col("inside") - len(MAGIC)
    rows = pieces.withColumn("inside", inside).join(blocks, ["file", "block"]).withColumn("start", at)
    return rows.select("place", "file", "start", (F.col("start") + F.col("reach")).alias("next"), "head", "fits", "length", "digest", "text_key").where("start >= 0")


def reachable(links: DataFrame) -> DataFrame:
    """Rows (file, start) of ``links`` (file, start, next) that the chain from offset 0 of the file reaches.

    Pointer jumping: after round k the set holds all records within 2**k steps and each pointer spans
    2**k steps, so the number of rounds is logarithmic in the records per file. One job per round.
    """
    jumps = cut_lineage(links.select("file", "start", "next").where("next is not null").distinct())
    reached = cut_lineage(links.where("start = 0").select("file", "start").distinct())
    count = reached.count()
    while True:
        steps = reached.join(jumps, ["file", "start"]).select("file", F.col("next").alias("start"))
        grown = cut_lineage(reached.unionByName(steps).distinct())
        release(reached)
        more = grown.count()
        reached = grown
        if more == count:
            break
        count = more
        ahead = jumps.select("file", F.col("start").alias("next"), F.col("next").alias("far"))
        longer = cut_lineage(jumps.join(ahead, ["file", "next"]).select("file", "start", F.col("far").alias("next")))
        release(jumps)
        jumps = longer
    release(jumps)
    return reached


def read_archives(spark: SparkSession, folder: str, *, with_payload: bool = False) -> DataFrame:
    """Records of the archives: file, start, main headers as columns, intact and, if asked for, payload (binary).

    ``intact`` says that the payload read back has the stored digest and length (null for a revisit).
    Texts are scanned a second time for records whose payload holds the magic, and if payloads are asked for.
    """
    texts = scan_pieces(spark, folder)
    pieces = parse_pieces(texts)
    found = cut_lineage(candidates(pieces))
    release(pieces)
    chain = reachable(found.select("file", "start", "next"))
    real = found.where("next is not null").join(chain, ["file", "start"])
    # pieces that the chain does not reach belong to the last record that starts before them
    marks = found.select("file", "start", "place", "text_key").join(real.select("place", F.col("place").alias("own")), "place", "left")
    owner = F.last("own", ignorenulls=True).over(Window.partitionBy("file").orderBy("start"))
    inner = cut_lineage(marks.withColumn("owner", owner).where("own is null and owner is not null").select("place", "owner", "text_key"))
    split = cut_lineage(real.where("not fits").select("place", "file", "start", "head", "text_key"))
    # pieces of equal text are alike, so each text is fetched once
    asked = broadcast_if_small(cut_lineage(inner.select("text_key").unionByName(split.select("text_key")).distinct()), max_rows=200_000)
    keyed = texts.select(text_key(F.col("value")).alias("text_key"), "value")
    fetched = cut_lineage(keyed.join(asked, "text_key").dropDuplicates(["text_key"]))
    tails = inner.join(fetched, "text_key").groupBy("owner").agg(
        F.concat_ws("", F.transform(F.sort_array(F.collect_list(F.struct("place", "value"))), lambda x: F.concat(F.lit(MAGIC), x["value"]))).alias("tail")
    )
    joined = split.join(fetched, "text_key").join(tails.withColumnRenamed("owner", "place"), "place", "left")
    joined = joined.withColumn("value", F.concat("value", F.coalesce("tail", F.lit(""))))
    whole = _fields(F.col("value"), F.col("head"))["payload"]
    long_ones = joined.select("file", "start", "head", whole.alias("payload"))
    slim = real.where("fits").select("file", "start", "head", "length", "digest", "text_key")
    long_ones = long_ones.withColumn("length", F.octet_length("payload")).withColumn("digest", F.sha2("payload", 256))
    if with_payload:
        every = keyed.dropDuplicates(["text_key"])
        slim = slim.join(every, "text_key").withColumn("payload", _fields(F.col("value"), F.col("head"))["payload"]).drop("value")
    else:
        long_ones = long_ones.drop("payload")
    slim = slim.drop("text_key")
    rows = slim.unionByName(long_ones)
    header = lambda name: F.nullif(F.regexp_extract("head", rf"(?i)(?:^|\r\n){name}:[ \t]*([^\r\n]*)", 1), F.lit(""))
    page = lambda name: F.regexp_extract("head", rf"(?:^|\r\n){name}: <urn:page:(-?[0-9]+)>", 1).try_cast("long")
    stored = F.regexp_replace(header("WARC-Payload-Digest"), "^sha256:", "")
    size = header("WARC-Payload-Length").try_cast("long")
    return rows.select(
        "file", "start",
        page("WARC-Record-ID").alias("page_id"),
        header("WARC-Type").alias("record_type"),
        header("WARC-Target-URI").alias("url"),
        stored.alias("payload_digest"),
        size.alias("payload_bytes"),
        page("WARC-Refers-To").alias("refers_to"),
        F.when(header("WARC-Type") == "response", (F.col("digest") == stored) & (F.col("length") == size)).alias("intact"),
        *(["payload"] if with_payload else []),
    )


def archive_round_trip(pages: DataFrame, folder: str | None = None, **options) -> DataFrame:
    """Write the pages as WARC files, read them back and report what the files hold, one row per record.

    Fails if a payload read back differs from its digest. The files go to ``folder`` or a new folder of the
    shared one.
    """
    spark = pages.sparkSession
    folder = folder or f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    write_archives(dedupe_payloads(pages, **options), folder)
    rows = read_archives(spark, folder)
    bad = F.raise_error(F.lit("a WARC payload differs from its digest")).cast("string")
    digest = F.when(F.coalesce("intact", F.col("record_type") == "revisit"), F.col("payload_digest")).otherwise(bad)
    return rows.select("page_id", "payload_bytes", digest.alias("payload_digest"), "record_type", "refers_to")
