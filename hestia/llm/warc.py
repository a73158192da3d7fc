"""WARC archives: writing with revisits, segments and chunked framing, and reading back.

Of pages with equal payloads the one with the largest id becomes a response
record, the others revisit it. A response is an HTTP message in chunked
transfer framing; a long one is cut into segments, the first in the response
record and the rest in continuation records that name it as their origin.
Archives are gzipped files of bounded size in the shared folder.

Reading parses the records of each file, gathers the segments of a record by
the identifier of their origin, orders them by number, checks that none is
missing and that their total length is the one stated, decodes the chunked
framing, and compares the payload's digest with the header.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hestia.llm.common import fresh_path

#: Characters of a chunk, chunks of a segment, records of a file. They bound a file's size and so a reading task's memory.
CHUNK, SEGMENT, PER_FILE = 2048, 4, 4000
DATE = "2024-01-01T00:00:00Z"
_HEX32, _BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_END = "\r\n"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"


def base32_sha1(payload: Column) -> Column:
    """SHA-1 of a text's UTF-8 in base 32: each 5 hex digits are 4 digits to the base 32."""
    h = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(h, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), _HEX32, _BASE32)


def with_revisits(pages: DataFrame, least: int = 0) -> DataFrame:
    """``pages`` (page_id, payload, ...) with ``payload_digest`` and ``refers_to``, null for responses.

    The largest id of each payload of at least ``least`` bytes is found with
    aggregates that combine before the shuffle; only payloads that occur more
    than once are joined back. Rows that repeat the response's id are
    responses too; where a payload has no id at all, all are responses.
    """
    p = pages.withColumn("payload_digest", base32_sha1(F.col("payload")))
    keys = pages.where(F.octet_length("payload") >= least).select("page_id", base32_sha1(F.col("payload")).alias("payload_digest"))
    last = keys.groupBy("payload_digest").agg(F.max("page_id").alias("last"), F.count("*").alias("n")).where("n > 1").select("payload_digest", "last")
    revisits = F.col("last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last")) & (F.octet_length("payload") >= least)
    return p.join(last, "payload_digest", "left").withColumn("refers_to", F.when(revisits, F.col("last"))).drop("last")


def _header(kind: str, *fields: tuple[str, Column], length: Column) -> Column:
    lines = [F.lit(f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Date: {DATE}\r\n")]
    lines += [F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(_END)), F.lit("")) for name, value in fields]
    return F.concat(*lines, F.lit("Content-Length: "), length.cast("string"), F.lit(_END * 2))


def records(pages: DataFrame) -> DataFrame:
    """One row ``value`` for each record, without the two line ends that close it."""
    url = F.regexp_replace(F.regexp_replace(F.coalesce("url", F.lit("")), "\r", "%0D"), "\n", "%0A")
    common = [
        ("WARC-Target-URI", url),
        ("X-Page-ID", F.col("page_id").cast("string")),
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
    ]
    chunks = F.regexp_extract_all("payload", F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))
    framed = F.transform(chunks, lambda c: F.concat(F.lower(F.hex(F.octet_length(c).cast("long"))), F.lit(_END), c, F.lit(_END)))
    # The record's identifier is drawn once, in the files that are written; a task that runs again writes its file anew.
    rows = pages.withColumns({"id": F.concat(F.lit("<urn:uuid:"), F.uuid(), F.lit(">")), "framed": F.concat(framed, F.array(F.lit("0\r\n\r\n")))})
    n = F.ceil(F.size("framed") / SEGMENT).cast("int")
    cut = F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice("framed", (i - 1) * SEGMENT + 1, SEGMENT), ""))
    responses = rows.where("refers_to is null").select("url", "page_id", "payload_digest", "id", F.transform(cut, lambda s, i: F.when(i == 0, F.concat(F.lit(_HTTP), s)).otherwise(s)).alias("segments"))
    total = F.aggregate("segments", F.lit(0).cast("long"), lambda a, s: a + F.octet_length(s))
    responses = responses.withColumn("total", F.when(F.size("segments") > 1, total)).select("*", F.posexplode("segments").alias("i", "block"))
    many = F.col("total").isNotNull()
    size = F.octet_length("block")
    number = ("WARC-Segment-Number", F.when(many, (F.col("i") + 1).cast("string")))
    first = F.concat(_header("response", ("WARC-Record-ID", F.col("id")), *common, number, ("Content-Type", F.lit("application/http;msgtype=response")), length=size), "block")
    is_last = F.col("i") == F.size("segments") - 1
    rest = F.concat(
        _header(
            "continuation",
            ("WARC-Record-ID", F.concat(F.left("id", F.length("id") - 1), F.lit("/"), F.col("i").cast("string"), F.lit(">"))),
            ("WARC-Segment-Origin-ID", F.col("id")),
            common[0],
            number,
            ("WARC-Segment-Total-Length", F.when(is_last, F.col("total").cast("string"))),
            length=size,
        ),
        "block",
    )
    revisit = F.concat(
        _header(
            "revisit",
            ("WARC-Record-ID", F.col("id")),
            *common,
            ("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
            ("X-Refers-To-Page-ID", F.col("refers_to").cast("string")),
            ("Content-Type", F.lit("application/http;msgtype=response")),
            length=F.lit(len(_HTTP)),
        ),
        F.lit(_HTTP),
    )
    written = responses.select(F.when(F.col("i") == 0, first).otherwise(rest).alias("value"))
    return written.unionAll(rows.where("refers_to is not null").select(revisit.alias("value")))


def write_archives(pages: DataFrame, path: str) -> None:
    """Writes the records of ``pages`` (page_id, url, payload, payload_digest, refers_to) under ``path``."""
    (
        records(pages).write.option("lineSep", _END * 2).option("compression", "gzip").option("maxRecordsPerFile", PER_FILE).text(path)
    )


def parsed(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of each record of an archive."""
    if data[:2] == b"\x1f\x8b":
        plain = []
        while data:  # members follow one another
            d = zlib.decompressobj(31)
            plain.append(d.decompress(data))
            data = d.unused_data
        data = b"".join(plain)
    at = 0
    while at < len(data):
        if not data.startswith(b"WARC/", at):
            raise ValueError(f"no record at byte {at}")
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split(_END)[1:]
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        begin, size = end + 4, int(fields["content-length"])
        yield fields, data[begin : begin + size]
        at = begin + size + 4


def unchunked(body: bytes) -> bytes:
    """The payload of a body in chunked transfer framing."""
    out, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        if not size:
            return b"".join(out)
        if len(body) < end + 4 + size or body[end + 2 + size : end + 4 + size] != b"\r\n":
            raise ValueError("a chunk doesn't end where it should")
        out.append(body[end + 2 : end + 2 + size])
        at = end + 4 + size


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of all archives under ``path``."""
    schema = "kind string, id string, origin string, number int, total long, page_id long, digest string, refers_to long, block binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.schema([("kind", pa.string()), ("id", pa.string()), ("origin", pa.string()), ("number", pa.int32()), ("total", pa.int64()), ("page_id", pa.int64()), ("digest", pa.string()), ("refers_to", pa.int64()), ("block", pa.binary())])
        number = lambda f, k: int(f[k]) if k in f else None
        for batch in batches:
            for data in batch.column(0):
                rows = []
                for f, block in parsed(data.as_py()):
                    rows.append((
                        f["warc-type"], f["warc-record-id"], f.get("warc-segment-origin-id"), number(f, "warc-segment-number"), number(f, "warc-segment-total-length"),
                        number(f, "x-page-id"), f.get("warc-payload-digest", "").removeprefix("sha1:") or None, number(f, "x-refers-to-page-id"), block,
                    ))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds.types)], schema=kinds)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content")
    return files.mapInArrow(run, schema)


def reassembled(found: DataFrame) -> DataFrame:
    """kind, page_id, refers_to, digest, parts (ordered blocks) and total, one row for each record that isn't a continuation.

    A record without segments needs no shuffle. The group of the others is
    one record's segments.
    """
    whole = found.where("number is null").select("kind", "page_id", "refers_to", "digest", F.array("block").alias("parts"), F.lit(True).alias("complete"), "total")
    of = found.where("number is not null").groupBy(F.coalesce("origin", "id").alias("record"))
    parts = of.agg(
        F.max(F.when(F.col("origin").isNull(), F.col("kind"))).alias("kind"),
        F.max("page_id").alias("page_id"),
        F.max("refers_to").alias("refers_to"),
        F.max("digest").alias("digest"),
        F.array_sort(F.collect_list(F.struct("number", "block"))).alias("s"),
        F.max("total").alias("total"),
    )
    numbers = F.transform("s", lambda x: x["number"])
    complete = F.col("total").isNotNull() & (numbers == F.sequence(F.lit(1), F.size("s")))
    return whole.unionAll(parts.select("kind", "page_id", "refers_to", "digest", F.transform("s", lambda x: x["block"]).alias("parts"), F.coalesce(complete, F.lit(False)).alias("complete"), "total"))


def _payloads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            data = b"".join(r["parts"])
            size, digest, problem = None, None, None
            if not r["complete"]:
                problem = "a segment is missing"
            elif r["total"] is not None and r["total"] != len(data):
                problem = "the total length differs"
            else:
                head, _, body = data.partition(b"\r\n\r\n")
                try:
                    payload = unchunked(body) if b"transfer-encoding: chunked" in head.lower() else body
                    size, digest = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
                    if r["digest"] and digest != r["digest"]:
                        problem = "the digest differs"
                except ValueError as e:
                    problem = str(e)
            rows.append((r["page_id"], size, digest, problem))
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)] if rows else [pa.array([], t) for t in kinds], names=["page_id", "payload_bytes", "payload_digest", "problem"])


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, problem of every page in the archives under ``path``.

    ``problem`` says what is wrong with a record that can't be read whole, else it is null.
    A revisit has the size of the response that it refers to; a hot response
    is one row on its side of that join.
    """
    found = read_records(spark, path)
    every = reassembled(found.where("kind != 'revisit'"))
    schema = "page_id long, payload_bytes long, payload_digest string, problem string"
    responses = every.select("page_id", "digest", "parts", "complete", "total").mapInArrow(_payloads, schema)
    of = responses.where("problem is null").groupBy(F.col("page_id").alias("refers_to"), "payload_digest").agg(F.max("payload_bytes").alias("payload_bytes"))
    revisits = found.where("kind = 'revisit'").select("page_id", F.col("digest").alias("payload_digest"), "refers_to")
    resolved = revisits.join(of, ["refers_to", "payload_digest"], "left").select(
        "page_id", "payload_bytes", "payload_digest", F.lit("revisit").alias("record_type"), "refers_to",
        F.when(F.col("payload_bytes").isNull(), "its response is missing").alias("problem"),
    )
    return responses.select("page_id", "payload_bytes", "payload_digest", F.lit("response").alias("record_type"), F.lit(None).cast("long").alias("refers_to"), "problem").unionAll(resolved)


def archive_and_read(pages: DataFrame, *, page_id: str = "page_id", url: str = "url", payload: str = "html", least: int = 0) -> DataFrame:
    """Archives every row of ``pages`` in the shared folder and returns what reading the archives gives.

    A null payload counts as empty, a null url too, a null id stays null; repeated rows
    have a record each; an empty table gives an empty one; other columns are
    not read.
    """
    spark = pages.sparkSession
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), F.coalesce(payload, F.lit("")).alias("payload"))
    path = fresh_path(spark, "warc")
    write_archives(with_revisits(rows, least), path)
    return read_archives(spark, path)
