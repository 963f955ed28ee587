"""WARC archives: written with segments and chunked bodies, read back and reassembled."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedmetrics.llm.base import staged, text_of

VERSION = b"WARC/1.1\r\n"
MARK = b"WARC/1."  # begins every record of the versions 1.x
BETWEEN = "\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"


def chunked(payload: bytes, size: int) -> bytes:
    """Chunked transfer framing. A chunk also ends inside ``WARC/1.``, so no payload holds a record's begin."""
    out, at = [], 0
    while at < len(payload):
        end = min(at + size, len(payload))
        inside = payload.find(MARK, at, end + len(MARK))
        if 0 <= inside < end:
            end = inside + 5
        out.append(b"%x\r\n%b\r\n" % (end - at, payload[at:end]))
        at = end
    return b"".join(out) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes | None:
    """The payload of a chunked body; None if the framing is broken."""
    out, at = [], 0
    while True:
        line = body.find(b"\r\n", at)
        try:
            size = int(body[at:line].split(b";")[0], 16) if line >= 0 else -1
        except ValueError:
            size = -1
        if size < 0:
            return None
        if size == 0:
            return b"".join(out)
        chunk = body[line + 2:line + 2 + size]
        if len(chunk) < size or body[line + 2 + size:line + 4 + size] != b"\r\n":
            return None
        out.append(chunk)
        at = line + 4 + size


def _record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [f"{name}: {value}" for name, value in [*fields, ("Content-Length", str(len(block)))]]
    return VERSION + "\r\n".join(lines).encode("utf-8", "replace") + b"\r\n\r\n" + block


def _pieces(block: bytes, size: int) -> list[bytes]:
    """Segments of at most ``size`` bytes; a cut inside ``WARC/1.`` cannot form one, since chunks break it."""
    return [block[i:i + size] for i in range(0, len(block), size)] or [b""]


def records_of(page_id: str | None, row: int, url: str | None, html: str, digest: str, original: str | None,
               chunk: int, segment: int) -> Iterator[bytes]:
    """The records of one page: a revisit, or a response in one or more segments."""
    own = f"<urn:page:{page_id or ''}:{row}>"
    fields = [("WARC-Date", DATE), ("WARC-Payload-Digest", f"sha256:{digest}")]
    if url:
        encoded = "".join(c if c > " " else f"%{ord(c):02X}" for c in url)
        fields.append(("WARC-Target-URI", encoded.replace(MARK.decode(), "WARC%2F1.")))
    if original is not None:
        yield _record([("WARC-Type", "revisit"), ("WARC-Record-ID", own), *fields,
                       ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                       ("WARC-Refers-To", f"<urn:page:{original}>")], b"")
        return
    block = HTTP_HEAD + chunked(html.encode("utf-8", "surrogatepass"), chunk)
    pieces = _pieces(block, segment)
    first = [("WARC-Type", "response"), ("WARC-Record-ID", own), *fields,
             ("Content-Type", "application/http; msgtype=response")]
    if len(pieces) == 1:
        yield _record(first, block)
        return
    yield _record([*first, ("WARC-Segment-Number", "1")], pieces[0])
    for number, piece in enumerate(pieces[1:], 2):
        rest = [("WARC-Type", "continuation"), ("WARC-Record-ID", f"{own[:-1]}:{number}>"), ("WARC-Date", DATE),
                ("WARC-Segment-Origin-ID", own), ("WARC-Segment-Number", str(number))]
        if number == len(pieces):
            rest.append(("WARC-Segment-Total-Length", str(len(block))))
        yield _record(rest, piece)


def write_archive(pages: DataFrame, path: str, least_bytes: int = 100, chunk_bytes: int = 4096,
                  segment_bytes: int = 8192, records_per_file: int = 100_000) -> None:
    """Writes pages(page_id, url, html) as WARC files under ``path``, in parallel.

    Of pages with equal payloads of ``least_bytes`` or more, the one with the
    smallest id is a response and the others are revisits of it; smaller
    payloads are always responses. Groups are found by an aggregate over
    digests, so a payload that many pages share is never gathered. Blocks beyond
    ``segment_bytes`` continue in further records.

    A null html is an empty payload. Rows that repeat the smallest id of a group
    are all responses; a page without an id revisits the group's first page, and
    is a response where no page of the group has an id. Control characters and
    spaces in a url are percent-encoded; a null url is left out.
    """
    rows = pages.select("page_id", "url", text_of("html").alias("html")).withColumn("digest", F.sha2("html", 256))
    firsts = rows.filter(F.octet_length("html") >= least_bytes).groupBy(F.col("digest").alias("__digest")).agg(
        F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("pages")).filter("pages > 1").drop("pages")
    firsts = staged(pages.sparkSession, firsts, "warc-firsts")
    rows = rows.join(firsts, F.col("digest") == F.col("__digest"), "left")
    original = F.when(~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id"))
    rows = rows.select(F.col("page_id").cast("string"), F.monotonically_increasing_id().alias("row"), "url", "html",
                       "digest", original.cast("string").alias("original"))

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out: list[bytes] = []
            for page in batch.itertuples(index=False):
                out += records_of(page.page_id, page.row, page.url, page.html, page.digest, page.original,
                                  chunk_bytes, segment_bytes)
                if len(out) >= 1000:
                    yield pd.DataFrame({"record": out})
                    out = []
            yield pd.DataFrame({"record": out}, dtype=object)

    records = rows.mapInPandas(encode, "record binary").select(F.col("record").cast("string").alias("record"))
    records.write.option("lineSep", BETWEEN).option("maxRecordsPerFile", records_per_file).text(path)


RECORD = ("record_id string, type string, uri string, digest string, refers_to string, origin string, "
          "segment bigint, total bigint, block binary")
COLUMNS = [c.split()[0] for c in RECORD.split(", ")]


def _number(text: str | None) -> int | None:
    try:
        return int(text) if text else None
    except ValueError:
        return None


def _parsed(raw: bytes) -> dict | None:
    """A record's fields; of what is not a record, its type ``unread`` alone, and nothing of blank space."""
    version, _, raw_head = raw.partition(b"\r\n")
    head, _, rest = raw_head.partition(b"\r\n\r\n")
    fields = {}
    for line in head.split(b"\r\n"):
        name, _, value = line.partition(b":")
        fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    if "warc-type" not in fields or not version.isdigit():
        return dict.fromkeys(COLUMNS) | {"type": "unread"} if raw.strip() else None
    length = _number(fields.get("content-length"))
    number, total = fields.get("warc-segment-number"), fields.get("warc-segment-total-length")
    sound = length is not None and 0 <= length <= len(rest) and (_number(number) is None) == (not number)
    return {"record_id": fields.get("warc-record-id"), "type": fields["warc-type"],
            "uri": fields.get("warc-target-uri"), "digest": fields.get("warc-payload-digest", "").rpartition(":")[2],
            "refers_to": fields.get("warc-refers-to"), "origin": fields.get("warc-segment-origin-id"),
            "segment": _number(number), "total": _number(total), "block": rest[:length] if sound else None}


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archives under ``path``, segments still apart.

    The begin of a record, of any version 1.x, is the separator Spark's text
    reader splits by, so a large file is read by many tasks. A record cut short,
    or with a number that is none, has a null block. Text that belongs to no
    record, as what follows such a begin inside a payload of an archive not
    written here, is a row of type ``unread``.
    """
    lines = spark.read.option("lineSep", MARK.decode()).text(path)

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [r for r in map(_parsed, batch["raw"]) if r]
            out = pd.DataFrame(found, columns=COLUMNS)
            yield out.astype({"segment": "Int64", "total": "Int64"})

    return lines.select(F.col("value").cast("binary").alias("raw")).filter(F.length("raw") > 0).mapInPandas(
        parse, RECORD)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """The logical records: record_id, type, uri, digest, refers_to, complete, payload.

    Continuation records are grouped by origin, ordered by segment number, and
    joined only if the numbers are gapless and the bytes make the total length.
    A group is one record's segments, so no group is larger than a record.
    Records that fit one segment are not shuffled. The HTTP body is then taken
    out of its chunked framing. ``complete`` is false, and the payload null,
    where length, numbering or framing is wrong. Revisits have no payload.
    """
    records = read_records(spark, path)
    whole = records.filter("segment IS NULL").select(
        "record_id", "type", "uri", "digest", "refers_to", F.col("block").isNotNull().alias("complete"), "block")
    parts = records.filter("segment IS NOT NULL").withColumn("key", F.coalesce("origin", "record_id"))
    first = F.col("type") != "continuation"
    groups = parts.groupBy("key").agg(
        *[F.max(F.when(first, F.col(c))).alias(c) for c in ("type", "uri", "digest", "refers_to")],
        F.max("total").alias("total"), F.sort_array(F.collect_list(F.struct("segment", "block"))).alias("parts"))
    numbers = F.transform("parts", lambda p: p["segment"])
    length = F.aggregate("parts", F.lit(0).cast("bigint"), lambda n, p: n + F.coalesce(F.length(p["block"]), F.lit(0)))
    joined = F.aggregate("parts", F.lit(b""), lambda b, p: F.concat(b, F.coalesce(p["block"], F.lit(b""))))
    groups = groups.select(
        F.col("key").alias("record_id"), "type", "uri", "digest", "refers_to",
        F.coalesce(F.col("type").isNotNull() & (length == F.col("total"))
                   & (numbers == F.sequence(F.lit(1).cast("bigint"), F.size("parts").cast("bigint"))),
                   F.lit(False)).alias("complete"), joined.alias("block"))

    @F.pandas_udf("binary")
    def body(blocks: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in blocks:
            out = []
            for block in batch:
                head, found, rest = (block or b"").partition(b"\r\n\r\n")
                framed = b"transfer-encoding: chunked" in head.lower()
                out.append((unchunked(rest) if framed else rest) if found else None)
            yield pd.Series(out, dtype=object)

    every = whole.unionByName(groups)
    every = every.withColumn("payload", F.when(F.col("complete") & (F.col("type") == "response"), body("block")))
    fine = F.col("complete") & ((F.col("type") != "response") | F.col("payload").isNotNull())
    return every.select("record_id", "type", "uri", "digest", "refers_to", fine.alias("complete"), "payload")


def pages_of(records: DataFrame) -> DataFrame:
    """Per page: page_id, payload_bytes, payload_digest, record_type, refers_to, from logical records.

    Bytes and digest of a revisit are those of the response it refers to. Damaged
    records, and revisits whose response is gone, have neither. Page ids that
    are not whole numbers are null.
    """
    def page(column: str):
        return F.regexp_extract(column, "^<urn:page:(-?[0-9]*)", 1).try_cast("bigint")

    rows = records.select(
        page("record_id").alias("page_id"), F.col("type").alias("record_type"), page("refers_to").alias("refers_to"),
        F.octet_length("payload").cast("bigint").alias("payload_bytes"),
        F.when(F.col("payload").isNotNull(), F.sha2("payload", 256)).alias("payload_digest"), "digest", "complete")
    rows = staged(records.sparkSession, rows, "warc-pages")  # read three times below; the archive but once
    revisit = F.coalesce(F.col("record_type") == "revisit", F.lit(False))
    responses = rows.filter(~revisit)
    known = responses.filter("complete AND record_type = 'response'").groupBy(F.col("page_id").alias("__id"), F.col("payload_digest").alias("__digest")).agg(
        F.max("payload_bytes").alias("__bytes"))
    revisits = rows.filter(revisit).join(
        known, F.col("complete") & (F.col("refers_to") == F.col("__id")) & (F.col("digest") == F.col("__digest")),
        "left")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return responses.select(*columns).unionByName(revisits.select(
        "page_id", F.col("__bytes").alias("payload_bytes"), F.col("__digest").alias("payload_digest"), "record_type",
        "refers_to"))
