"""WARC archives: writing them, and reading them by boundary-chain verification.

Reading cuts the files at every occurrence of the record magic, splits of a
file in parallel. Every occurrence is a candidate record; its header says
where the next record would start. Pointer jumping from the start of each
file (every candidate's pointer is doubled until none is left) finds the
candidates that a reader walking the file would visit. The others are magic
inside payloads and become part of the record that holds them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata_engine.llm.common import named
from strata_engine.session import fits_broadcast, materialize

MAGIC = "WARC/1.0\r\n"
BREAK = "\r\n\r\n"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"


def base32_sha1(data: Column) -> Column:
    """Bare upper-case base32 of the SHA-1 of a binary column: eight groups
    of 20 bits, four characters each."""
    digest = F.sha1(data)
    chars = []
    for group in range(8):
        bits = F.conv(F.substring(digest, 5 * group + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            at = F.shiftright(bits, shift).bitwiseAND(F.lit(31))
            chars.append(F.substring(F.lit(BASE32), at + 1, F.lit(1)))
    return F.concat(*chars)


def plan_records(pages: DataFrame, min_payload: int = 0) -> DataFrame:
    """page_id, url, payload, digest, refers_to of every page. Of equal
    payloads of at least ``min_payload`` bytes the smallest page_id holds the
    payload; the others refer to it."""
    pages = pages.withColumn("digest", base32_sha1(F.col("payload")))
    # a hot payload is one partial row per task; only repeated ones go on
    shared = (
        pages.where(F.length("payload") >= min_payload)
        .groupBy("digest", F.length("payload").alias("size"))
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 and first is not null")
        .select("digest", "size", "first")
    )
    members = pages.where(F.length("payload") >= min_payload).select("page_id", "digest", F.length("payload").alias("size"))
    shared = materialize(shared, "warc-shared")
    if fits_broadcast(shared):
        shared = F.broadcast(shared)
    revisits = members.join(shared, ["digest", "size"]).where("page_id <> first").select("page_id", "first", "digest").distinct()
    revisits = materialize(revisits, "warc-revisits")
    # the payloads move only where the list of revisits is too long to send along
    if fits_broadcast(revisits):
        revisits = F.broadcast(revisits)
    return pages.join(revisits, ["page_id", "digest"], "left").withColumnRenamed("first", "refers_to")


def record_text(record_id: Column, url: Column, payload: Column, digest: Column, refers_to: Column) -> Column:
    """One WARC record without the closing blank lines (the file's line
    separator). The block is an HTTP response; a revisit has its headers only."""
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.length(payload).cast("string"),
        F.lit(BREAK),
    )
    revisit = refers_to.isNotNull()
    block_bytes = F.octet_length(http) + F.when(revisit, 0).otherwise(F.length(payload))
    # control characters would break the header
    target = F.regexp_replace(F.coalesce(url, F.lit("")), r"[\x00-\x20\x7f]", "%20")
    urn = F.concat(F.lit("urn:page:"), F.coalesce(record_id.cast("string"), F.lit("")))
    return F.concat(
        F.lit(MAGIC + "WARC-Type: "),
        F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
        F.lit("\r\nWARC-Record-ID: <"), urn, F.lit(">"),
        F.lit(f"\r\nWARC-Date: {DATE}\r\nWARC-Target-URI: "),
        F.when(target == "", urn).otherwise(target),
        F.lit("\r\nWARC-Payload-Digest: sha1:"), digest,
        F.when(
            revisit,
            F.concat(
                F.lit(f"\r\nWARC-Profile: {REVISIT_PROFILE}\r\nWARC-Refers-To: <urn:page:"), refers_to.cast("string"), F.lit(">")
            ),
        ).otherwise(F.lit("")),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        block_bytes.cast("string"),
        F.lit(BREAK),
        http,
        F.when(revisit, F.lit("")).otherwise(payload.cast("string")),
    )


def write_archives(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    min_payload: int = 0,
    records_per_file: int = 2_000,
) -> None:
    """Write one record per row of ``pages`` to WARC files under ``path``.
    Null html is an empty payload; a null id is written as an empty one; rows
    alike in id and payload are all responses, or all revisits."""
    src = named(pages, page_id=id_col, url=url_col, payload=html_col)
    src = src.withColumn("payload", F.coalesce(F.col("payload").cast("string").cast("binary"), F.lit(b"")))
    records = plan_records(src, min_payload).select(
        record_text(F.col("page_id"), F.col("url"), F.col("payload"), F.col("digest"), F.col("refers_to")).alias("value")
    )
    records.write.option("lineSep", BREAK).option("maxRecordsPerFile", records_per_file).text(path)


def _field(header: Column, name: str, value: str) -> Column:
    found = F.regexp_extract(header, rf"(?im)^{name}:[ \t]*{value}", 1)
    return F.when(found != "", found)


def _segments(spark: SparkSession, path: str) -> DataFrame:
    """The bytes between occurrences of the magic, with file, block (split)
    and row (their order in it)."""
    raw = spark.read.option("lineSep", MAGIC).option("recursiveFileLookup", "true").text(path)
    return raw.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
        "value",
    )


def candidates(raw: DataFrame) -> DataFrame:
    """Every occurrence of the magic in ``_segments``: file, at (its offset),
    to (where its record ends), header fields, and size, digest of the
    payload. Where the record does not end at the next magic, ``piece`` has
    the bytes up to it."""
    header = F.substring_index("value", BREAK, 1)
    both = F.substring_index("value", BREAK, 2)
    head_bytes, both_bytes = F.octet_length(header), F.octet_length(both)
    segments = raw.select(
        "file",
        "block",
        "row",
        F.octet_length("value").cast("bigint").alias("bytes"),
        _field(header, "WARC-Type", r"([a-z]+)").alias("type"),
        _field(header, "WARC-Record-ID", r"<([^>]*)>").alias("record_id"),
        _field(header, "WARC-Refers-To", r"<([^>]*)>").alias("refers_to"),
        _field(header, "WARC-Payload-Digest", r"sha1:([A-Z2-7]{32})").alias("stated_digest"),
        _field(header, "Content-Length", r"(\d{1,15})\b").cast("bigint").alias("content"),
        head_bytes.cast("bigint").alias("head"),
        (both_bytes - head_bytes - 4).cast("bigint").alias("http"),
        _field(F.substring_index(both, BREAK, -1), "Content-Length", r"(\d{1,15})\b").cast("bigint").alias("stated_bytes"),
        F.col("value").cast("binary").alias("data"),
    )
    length = F.col("head") + 4 + F.col("content") + 4  # of the whole record without its magic
    whole = F.coalesce(F.col("bytes") == length, F.lit(False))
    payload = F.expr("substring(data, int(head + 4 + http + 4 + 1), int(content - http - 4))")
    segments = segments.select(
        "file", "block", "row", "bytes", "type", "record_id", "refers_to", "stated_digest", "stated_bytes",
        length.alias("length"),
        F.when(whole & (F.col("type") == "response"), base32_sha1(payload)).alias("digest"),
        F.when(whole & (F.col("type") == "response"), F.length(payload)).cast("bigint").alias("size"),
        F.when(~whole, F.col("data")).alias("piece"),
    )
    order = Window.partitionBy("file").orderBy("block", "row")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    magic = len(MAGIC)
    # the first segment of a file is what stands before its first magic
    number = F.row_number().over(order)
    at = F.coalesce(F.sum("bytes").over(before), F.lit(0)) + (number - 2) * magic
    placed = segments.withColumn("at", at).withColumn("number", number)
    placed = placed.withColumn("end", F.max(F.col("at") + magic + F.col("bytes")).over(Window.partitionBy("file")))
    return (
        placed.where("number > 1")
        .withColumn("to", F.col("at") + magic + F.col("length"))
        .drop("number", "length")
    )


def reachable(links: DataFrame) -> DataFrame:
    """file, at of the candidates on the chain from offset 0 of each file, by
    pointer jumping: after round k every pointer spans 2^k records and every
    record less than 2^k steps from the start is marked. ``links`` has file,
    at, to; a pointer that hits no candidate ends its chain."""
    targets = links.select("file", F.col("at").alias("to")).distinct()
    state = links.select("file", "at", "to").join(targets.withColumn("ok", F.lit(True)), ["file", "to"], "left")
    state = materialize(
        state.select("file", "at", F.when(F.col("ok"), F.col("to")).alias("to"), (F.col("at") == 0).alias("marked")), "warc-links"
    )
    most = state.groupBy("file").count().agg(F.max("count")).first()[0] or 0
    for _ in range(math.ceil(math.log2(most + 1)) if most else 0):
        hit = state.where("marked and to is not null").select("file", F.col("to").alias("at"), F.lit(True).alias("hit")).distinct()
        jump = state.where("to is not null").select("file", F.col("at").alias("to"), F.col("to").alias("next"))
        state = materialize(
            state.join(hit, ["file", "at"], "left")
            .join(jump, ["file", "to"], "left")
            .select("file", "at", F.col("next").alias("to"), (F.col("marked") | F.coalesce("hit", F.lit(False))).alias("marked")),
            "warc-jump",
        )
    return state.where("marked").select("file", "at")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """file, at, record_id, record_type, payload_bytes, payload_digest,
    refers_to (a record id) of every complete record on the chains. Size and
    digest of a response are those of the bytes read; a revisit has those
    that its headers state. A file that does not start with a record, or the
    rest of one whose chain breaks, gives nothing; no files, no rows."""
    raw = _segments(spark, path)
    found = materialize(candidates(raw), "warc-candidates")
    links = found.where("to <= end").select("file", "at", "to")
    on_chain = reachable(links).withColumn("record", F.col("at"))
    marked = found.join(on_chain, ["file", "at"], "left")
    # a candidate off the chain lies in the payload of the last record before it
    before = Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    marked = marked.withColumn("owner", F.last("record", True).over(before))
    marked = marked.withColumn("owner_to", F.last(F.when(F.col("record").isNotNull(), F.col("to")), True).over(before))
    marked = materialize(marked, "warc-marked")
    inside = marked.where("at < owner_to")
    parts = inside.where("piece is not null").select("file", "owner", "at", "piece")
    # what looks like a whole record inside a payload was not kept: read it again
    again = inside.where("piece is null and record is null").select("file", "block", "row", "bytes", "owner", "at")
    lost = again.count()
    if lost:
        reread = raw.join(again, ["file", "block", "row"]).where(F.octet_length("value") == F.col("bytes"))
        reread = materialize(reread.select("file", "owner", "at", F.col("value").cast("binary").alias("piece")), "warc-again")
        if reread.count() != lost:
            raise RuntimeError("the archives changed while they were read")
        parts = parts.unionByName(reread)
    cut = parts.groupBy("file", F.col("owner").alias("at")).agg(
        F.sort_array(F.collect_list(F.struct("at", "piece"))).alias("held"), F.count(F.lit(1)).alias("n")
    )
    rejoined = cut.where("n > 1").select("file", "at", _joined(F.col("held.piece")).alias("data"))
    records = marked.where("record is not null").join(rejoined, ["file", "at"], "left")
    head = F.octet_length(F.substring_index(F.col("data").cast("string"), BREAK, 2)) + len(BREAK)
    size = F.col("to") - F.col("at") - len(MAGIC) - head - len(BREAK)
    records = records.withColumn("body", F.col("data").substr(head + 1, size.cast("int")))
    response = F.col("type") == "response"
    return records.select(
        "file",
        "at",
        "record_id",
        F.col("type").alias("record_type"),
        F.when(response, F.coalesce("size", F.length("body").cast("bigint"))).otherwise(F.col("stated_bytes")).alias("payload_bytes"),
        F.when(response, F.coalesce("digest", base32_sha1(F.col("body")))).otherwise(F.col("stated_digest")).alias("payload_digest"),
        "refers_to",
    )


def _joined(pieces: Column) -> Column:
    """The pieces with the magic between them: the bytes as they stood."""
    return F.aggregate(
        F.slice(pieces, 2, F.greatest(F.size(pieces), F.lit(1))),
        F.element_at(pieces, 1),
        lambda held, piece: F.concat(held, F.lit(MAGIC.encode()), piece),
    )

