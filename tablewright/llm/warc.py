"""WARC archives written by Spark's text sink, and a reader that salvages damaged ones.

A record is a version line, header lines, an empty line, the block and two line ends. The sink puts a
separator after each value, so files of any number of records arise without a task holding them.
In plain files the separator is the two line ends. In compressed files every record is a gzip member;
its last byte, the highest of the content's length, is zero below 16 MB, and that zero is the separator.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import map_arrow

# Fixed values of the format.
VERSION = "WARC/1.1"
LINE_END = "\r\n"
GZIP_START = b"\x1f\x8b\x08"
VERSION_LINE = re.compile(rb"WARC/1\.[01]\r\n")
ID_PREFIX = "urn:x-page:"

RECORDS_PER_FILE = 4096

RECORD_SCHEMA = (
    "file string, start long, length long, status string, kind string, page_id long, uri string, "
    "payload_bytes long, payload_digest string, refers_to long, inner_start long, inner_length long, payload binary"
)


class Record(NamedTuple):
    headers: dict[str, str]
    payload: bytes
    end: int


def mark_revisits(pages: DataFrame, at_least: int = 100) -> DataFrame:
    """(page_id, refers_to) of pages whose payload of ``at_least`` bytes a smaller page_id has too.

    Only ids and digests are shuffled, and copies are counted before they are: a payload that a third
    of all pages share is one row per task. Pages without an id neither refer nor are referred to.
    """
    keyed = pages.select("page_id", F.sha2(_html().cast("binary"), 256).alias("digest"), F.octet_length(_html()).alias("n"))
    keyed = keyed.filter((F.col("n") >= at_least) & F.col("page_id").isNotNull()).select("page_id", "digest")
    first = (
        keyed.groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.max("page_id").alias("last"))
        .filter("first < last")
        .select("digest", F.col("first").alias("refers_to"))
    )
    return keyed.join(first, "digest").filter("page_id > refers_to").select("page_id", "refers_to").distinct()


def _html():
    return F.coalesce(F.col("html"), F.lit(""))


def _zipped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every record as a gzip member without its last byte, which is zero."""
    empty = zlib.compress(b"", wbits=31)
    for batch in batches:
        members = []
        for record in batch.column(0).to_pylist():
            data = record.encode() + b"\r\n\r\n"
            member = zlib.compress(data, wbits=31)
            # A longer record is followed by an empty member, which ends in zeros.
            members.append((member if len(data) < 1 << 24 else member + empty)[:-1])
        yield pa.RecordBatch.from_arrays([pa.array(members, pa.binary())], names=["value"])


def write_warc(
    pages: DataFrame, path: str, records_per_file: int = RECORDS_PER_FILE, at_least: int = 100, compress: bool = True
) -> None:
    """Write a record per row of (page_id, url, html) below ``path``, as gzip members or plain.

    Null html is an empty payload, a null url has no target line, a null page_id no record id. Line ends
    in urls are percent-encoded. Rows that repeat a page_id repeat its record. Other columns are ignored.
    """
    pages = pages.select("page_id", "url", "html")
    refers = mark_revisits(pages, at_least)
    refers = refers.select(F.col("page_id").alias("id"), "refers_to")
    rows = pages.join(refers, F.col("page_id") == F.col("id"), "left").drop("id")
    html, revisit = _html(), F.col("refers_to").isNotNull()
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{LINE_END}Content-Type: text/html; charset=utf-8{LINE_END}Content-Length: "),
        F.octet_length(html).cast("string"),
        F.lit(LINE_END * 2),
    )
    block = F.when(revisit, http).otherwise(F.concat(http, html))
    uri = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    digest = F.sha2(html.cast("binary"), 256)

    def line(name, value):
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(LINE_END)), F.lit(""))

    def page_uri(column):
        return F.concat(F.lit(f"<{ID_PREFIX}"), F.col(column).cast("string"), F.lit(">"))

    record = F.concat(
        F.lit(VERSION + LINE_END),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", page_uri("page_id")),
        line("WARC-Target-URI", uri),
        line("WARC-Refers-To", page_uri("refers_to")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), digest)),
        line("WARC-Payload-Length", F.octet_length(html).cast("string")),
        line("WARC-Block-Digest", F.concat(F.lit("sha256:"), F.sha2(block.cast("binary"), 256))),
        line("Content-Type", F.lit("application/http;msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit(LINE_END),
        block,
    )
    out = rows.select(record.alias("value"))
    if compress:
        out = map_arrow(out, _zipped, "value binary").select(F.col("value").cast("string").alias("value"))
    separator = "\0" if compress else LINE_END * 2
    out.write.option("lineSep", separator).option("maxRecordsPerFile", records_per_file).text(path)


def parse_record(data: bytes, at: int) -> Record | None:
    """The record that starts at ``at``, or None if any of its checks fails."""
    line = VERSION_LINE.match(data, at)
    body = data.find(b"\r\n\r\n", at)
    if not line or body < 0:
        return None
    headers: dict[str, str] = {}
    for raw in data[line.end() : body].split(b"\r\n"):
        name, colon, value = raw.partition(b":")
        if not colon:
            return None
        headers[name.decode("latin-1").strip().lower()] = value.decode("utf-8", "replace").strip()
    length = headers.get("content-length", "")
    if not re.fullmatch("[0-9]{1,18}", length):
        return None
    start, end = body + 4, body + 4 + int(length)
    if data[end : end + 4] != b"\r\n\r\n":
        return None
    block = data[start:end]
    if not _digest_holds(headers.get("warc-block-digest"), block):
        return None
    payload = block
    if headers.get("content-type", "").startswith("application/http"):
        head, gap, payload = block.partition(b"\r\n\r\n")
        if not gap:
            return None
    if headers.get("warc-type") != "revisit" and not _digest_holds(headers.get("warc-payload-digest"), payload):
        return None
    return Record(headers, payload, end + 4)


def _digest_holds(said: str | None, data: bytes) -> bool:
    if not said:
        return True
    kind, _, value = said.partition(":")
    return kind.lower() != "sha256" or hashlib.sha256(data).hexdigest() == value.lower()


def _member(data: bytes, at: int) -> tuple[bytes, int, bool]:
    """Content of the gzip member at ``at``, where it ends, and whether stream and checksum hold.

    Of a broken stream the content is what inflates before the error, and the end is where that was found.
    """
    inflate, view = zlib.decompressobj(wbits=31), memoryview(data)
    try:
        content = inflate.decompress(view[at:])
        return content, len(data) - len(inflate.unused_data), inflate.eof
    except zlib.error:
        pass
    # A call that fails gives nothing back, so the bytes go in by portions, those of the failing one one by one.
    inflate, parts, portion = zlib.decompressobj(wbits=31), [], 1 << 14
    while True:
        before = inflate.copy()
        try:
            parts.append(inflate.decompress(view[at : at + portion]))
            at += portion
        except zlib.error:
            if portion == 1:
                return b"".join(parts), at, False
            inflate, portion = before, 1


def _has_digest(headers: dict[str, str]) -> bool:
    names = ["warc-block-digest"] if headers.get("warc-type") == "revisit" else ["warc-block-digest", "warc-payload-digest"]
    return any(headers.get(n, "").lower().startswith("sha256:") for n in names)


def _inside(content: bytes, whole: bool) -> list[tuple[tuple[int, int], Record | None]]:
    """((offset, length), record) of the records and gaps in what a member holds.

    If the member is not whole, its checksum vouches for nothing: records need a digest of their own, and
    the last entry is the gap at its end, of any length.
    """
    out: list[tuple[tuple[int, int], Record | None]] = []
    at = gap = 0
    while at < len(content):
        record = parse_record(content, at)
        if record and (whole or _has_digest(record.headers)):
            if at > gap:
                out.append(((gap, at - gap), None))
            out.append(((at, record.end - at), record))
            at = gap = record.end
        else:
            following = VERSION_LINE.search(content, at + 1)
            at = following.start() if following else len(content)
    if gap < len(content) or not whole:
        out.append(((gap, len(content) - gap), None))
    return out


def salvage_inside(data: bytes) -> Iterator[tuple[int, int, str, Record | None, tuple[int, int] | None]]:
    """(start, length, status, record, inner) for every record and every gap, in order, covering all bytes.

    Status is ``ok`` for a record, ``recovered`` for the first record after a gap, and ``quarantined``
    for a gap (record None). Start and length are those in the file; records and gaps inside one gzip member
    share the member's, and inner is their (offset, length) in what the member holds. A broken member ends where
    the next record or member is found; one without any good record is part of a gap.
    """
    damaged = False

    def rows(start: int, end: int, parts: list):
        nonlocal damaged
        for inner, record in parts:
            status = "quarantined" if record is None else "recovered" if damaged else "ok"
            damaged = record is None
            yield start, end - start, status, record, inner

    at = 0
    gap: int | None = None  # start of damaged bytes whose end is still searched
    held: list = []  # what they gave, if they are a broken member, and the end of what of it inflates
    inflated = 0
    while at < len(data):
        parts: list = []
        end, whole = at, True
        if data.startswith(GZIP_START, at):
            content, end, whole = _member(data, at)
            parts = _inside(content, whole)
            if not any(record for _, record in parts):
                end, parts = end if whole and not content else at, []
        elif record := parse_record(data, at):
            # A stored member shows its records in plain, which were found inside it.
            if at >= inflated or all(record[:2] != r[:2] for _, r in held if r):
                parts, end = [(None, record)], record.end
        if parts:
            if gap is not None:
                yield from rows(gap, at, held or [(None, None)])
            gap, held = None, []
            if whole:
                yield from rows(at, end, parts)
            else:
                gap, held, inflated = at, parts, end
        if end > at and whole:
            at = end
            continue
        gap = at if gap is None else gap
        following = VERSION_LINE.search(data, at + 1)
        zipped = data.find(GZIP_START, at + 1)
        starts = [x for x in (following.start() if following else -1, zipped) if x >= 0]
        at = min(starts, default=len(data))
    if gap is not None:
        yield from rows(gap, len(data), held or [(None, None)])


def salvage(data: bytes) -> Iterator[tuple[int, int, str, Record | None]]:
    """What ``salvage_inside`` gives, without the places inside members."""
    for row in salvage_inside(data):
        yield row[:4]


def _page(uri: str | None) -> int | None:
    found = re.fullmatch(rf"<?{ID_PREFIX}(-?[0-9]+)>?", uri or "")
    return int(found[1]) if found else None


def _number(text: str | None, otherwise: int) -> int:
    return int(text) if text and text.isdigit() else otherwise


def read_warc(spark, path: str, payloads: bool = True) -> DataFrame:
    """All records and quarantined gaps of the archives below ``path``, one row each.

    A file is the unit of reading, so keep files small (``records_per_file``). Rows of status
    ``quarantined`` log damaged byte ranges; their other columns are null, but for ``inner_start`` and
    ``inner_length``, the place in the content of a gzip member. An empty folder gives no rows.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    schema = RECORD_SCHEMA if payloads else RECORD_SCHEMA.removesuffix(", payload binary")
    names = [x.split()[0] for x in schema.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
        types += [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]

        def batch(rows):
            columns = list(zip(*rows, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=False)], names=names)

        for files in batches:
            for i in range(files.num_rows):
                name, data = files.column(0)[i].as_py(), files.column(1)[i].as_py()
                rows: list[tuple] = []
                held = 0
                for start, length, status, record, inner in salvage_inside(data):
                    row: tuple = (name, start, length, status)
                    if record is None:
                        row += (*(None,) * 6, *(inner or (None, None)), None)
                    else:
                        h = record.headers
                        said = h.get("warc-payload-digest", "").removeprefix("sha256:").lower()
                        row += (
                            h.get("warc-type"),
                            _page(h.get("warc-record-id")),
                            h.get("warc-target-uri"),
                            _number(h.get("warc-payload-length"), len(record.payload)),
                            said or hashlib.sha256(record.payload).hexdigest(),
                            _page(h.get("warc-refers-to")),
                            *(inner or (None, None)),
                            record.payload,
                        )
                        held += len(record.payload) if payloads else 0
                    rows.append(row[: len(names)])
                    if len(rows) >= 5000 or held > 8_000_000:
                        yield batch(rows)
                        rows, held = [], 0
                if rows:
                    yield batch(rows)

    return map_arrow(files, read, schema)
