"""WARC archives: a writer on the text sink, and a reader that salvages what a damaged archive still holds."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import durable, in_arrow, made, small

#: Rows up to which the digests of repeated payloads are broadcast (about 60 bytes each).
BROADCAST_DIGESTS = 1_000_000
#: Fixed values of the WARC and gzip formats.
END, BLANK, MEMBER = b"\r\n\r\n", b"\r\n\r\n", b"\x1f\x8b\x08"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Bytes that an archive may hold (the reader takes one whole), beyond which a record has one to itself; inflated bytes of a gzip member that are held at
#: once: a larger one is inflated again and parsed as it goes, with the same records.
ARCHIVE, MEMBER_BYTES, WINDOW = 128 << 20, 64 << 20, 4 << 20
#: Fixed value: characters that a version line has at most.
VERSION_BYTES = 32
LENGTH = re.compile(r"[0-9]{1,18}")
VERSION = re.compile(rb"WARC/[01]\.[0-9]+\r?\n")
START = re.compile(rb"WARC/[01]\.[0-9]+\r?\n|\x1f\x8b\x08")


def as_records(pages: DataFrame, least: int = 1000) -> DataFrame:
    """pages (page_id, url, html) with payload, payload_bytes, payload_digest (SHA-1, lower-case hex), record_type and refers_to.

    A null payload is empty. Of equal payloads of at least least bytes the one with the largest page_id is the response
    and others revisit it; rows that share that page_id are all responses, and a row without an id revisits it. Payloads only move
    if the repeated digests are too many to be broadcast.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumns({"payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": F.sha1(F.col("payload").cast("binary"))})
    often = rows.where(F.col("payload_bytes") >= least).groupBy("payload_digest").agg(F.count("*").alias("n"), F.max("page_id").alias("last")).where("n > 1 AND last IS NOT NULL").select("payload_digest", "last")
    often = durable(often, "digests")
    often = F.broadcast(often) if small(often, BROADCAST_DIGESTS) else often
    other = F.col("last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last"))
    return rows.join(often, "payload_digest", "left").withColumns({"record_type": F.when(other, "revisit").otherwise("response"), "refers_to": F.when(other, F.col("last"))}).drop("last")


def record_text(prefix: str, date: str) -> Column:
    """One whole record but for its end mark."""
    line = lambda name, value: F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))
    name = lambda c: F.concat(F.lit(f"<{prefix}"), F.coalesce(F.col(c).cast("string"), F.lit("none")), F.lit(">"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"), line("Content-Length", F.col("payload_bytes").cast("string")), F.lit("\r\n"))
    revisit = F.col("record_type") == "revisit"
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    return F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", name("page_id")),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", F.regexp_replace(F.col("url").cast("string"), r"[\x00-\x20\x7f]", "")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        line("WARC-Refers-To", F.when(revisit, name("refers_to"))),
        line("WARC-Profile", F.when(revisit, F.lit(IDENTICAL))),
        F.lit("Content-Type: application/http;msgtype=response\r\n"),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
        block,
    )


def write_warc(records: DataFrame, path: str, per_file: int = 2000, prefix: str = "urn:x-page:", date: str = "2024-01-01T00:00:00Z") -> None:
    """Archives of at most per_file records and, but for a longer record alone, ARCHIVE bytes, one or more a task. The text sink writes
    the records as they are, with the end mark of a record as its line end, so nothing leaves the JVM. Records are written by classes of
    size, each a folder, as the sink counts records only; an empty table gives an empty folder."""
    # a record's length but for the payload comes from its url; a class has records of at most four times the length of its shortest
    size = F.when(F.col("record_type") == "revisit", 0).otherwise(F.col("payload_bytes")) + F.coalesce(F.octet_length(F.col("url").cast("string")), F.lit(0)) + 1024
    least = max(1, ARCHIVE // per_file)
    rows = records.select(record_text(prefix, date).alias("value"), F.greatest(F.lit(0), F.ceil(F.log2(size / least) / 2)).cast("int").alias("size_class"))
    classes = records.select(F.max(size).alias("most")).first()["most"] or 0
    k = 0
    while True:
        many = max(1, per_file >> 2 * k)
        part = rows.where(F.col("size_class") == k).select("value")
        part.write.option("lineSep", END.decode()).option("maxRecordsPerFile", many).mode("append").text(path)
        if least << 2 * k >= classes:
            break
        k += 1


@dataclass
class Record:
    start: int
    end: int
    headers: dict[str, str]
    block: bytes


def parse_record(data: bytes, at: int) -> Record | str:
    """The record at a place, or why there is none."""
    if not (m := VERSION.match(data, at)):
        return "no version line"
    stop = data.find(BLANK, m.end() - 2)
    if stop < 0:
        return "headers don't end"
    headers: dict[str, str] = {}
    for line in data[m.end() : stop].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if line and not colon:
            return "a header without a colon"
        headers[name.decode("latin-1").strip().lower()] = value.decode("utf-8", "replace").strip()
    length = headers.get("content-length", "")
    if not LENGTH.fullmatch(length):
        return "no length"
    begin, end = stop + 4, stop + 4 + int(length)
    if end > len(data):
        return "cut short"
    if data[end : end + 4] != END:
        return "no end mark where the length says"
    record = Record(at, end + 4, headers, data[begin:end])
    declared = headers.get("warc-block-digest", "")
    if declared.lower().startswith("sha1:") and len(declared) == 45 and hashlib.sha1(record.block).hexdigest() != declared[5:].lower():
        return "block digest differs"
    if headers.get("warc-type") == "response" and (declared := headers.get("warc-payload-digest", "")).lower().startswith("sha1:") and len(declared) == 45:
        if hashlib.sha1(payload_of(record)).hexdigest() != declared[5:].lower():
            return "payload digest differs"
    return record


def payload_of(record: Record) -> bytes:
    if not record.headers.get("content-type", "").startswith("application/http"):
        return record.block
    return record.block.partition(BLANK)[2]


def inflated(data: bytes, at: int) -> Iterator[bytes]:
    """What a gzip member holds, as far as it can be read; returns where it ends and why it does not end well (else empty)."""
    unzip, view, place = zlib.decompressobj(31), memoryview(data), at
    try:
        while not unzip.eof and place < len(data):
            yield unzip.decompress(view[place : place + (1 << 16)], 1 << 22)
            place += 1 << 16
            while unzip.unconsumed_tail and not unzip.eof:
                yield unzip.decompress(unzip.unconsumed_tail, 1 << 22)
    except zlib.error as e:
        return at, f"gzip: {e}"
    if not unzip.eof:
        return at, "gzip member cut short"
    return min(place, len(data)) - len(unzip.unused_data), ""


def inflate(data: bytes, at: int) -> tuple[bytes | None, int, str]:
    """What a gzip member holds as far as it can be read (None if it is more than MEMBER_BYTES), where it ends, and why it does not end well (else empty)."""
    parts, out, size = inflated(data, at), [], 0
    while True:
        try:
            part = next(parts)
        except StopIteration as stop:
            return (b"".join(out) if size <= MEMBER_BYTES else None), *stop.value
        size += len(part)
        if size <= MEMBER_BYTES:
            out.append(part)
        else:
            out.clear()


def streamed(data: bytes, at: int) -> Iterator[Record | tuple[int, int, str]]:
    """records_of() what a large gzip member holds, of which no more is held than a record and the stretch behind it that fails need."""
    parts, held, place, ended, bad, why = inflated(data, at), b"", 0, False, False, ""

    def more() -> None:
        """Reads on, so much that what is held has grown by half at least."""
        nonlocal held, place, ended
        new, size = [held[place:]], 0
        while size < max(WINDOW, len(held) // 2) and not ended:
            part = next(parts, None)
            ended = part is None
            new.append(part or b"")
            size += len(new[-1])
        held, place = b"".join(new), 0

    while True:
        if place >= len(held) - VERSION_BYTES and not ended:
            more()
            continue
        if place >= len(held):
            break
        found = parse_record(held, place)
        if isinstance(found, Record):
            if bad:
                yield 0, 0, why
                bad = False
            place = found.end
            yield found
            continue
        if not ended and found in ("headers don't end", "cut short", "no end mark where the length says"):
            more()  # what isn't there yet may follow
            continue
        bad, why = True, why if bad else found
        following = VERSION.search(held, place + 1)
        place = following.start() if following else len(held) if ended else max(place + 1, len(held) - VERSION_BYTES)
    if bad:
        yield 0, 0, why


def parse_member(data: bytes, at: int) -> tuple[Iterator[Record | tuple[int, int, str]], int] | str:
    """The records of a gzip member at a place, with a gap (all its bytes) for what of it fails, and where the member ends; or why there are
    none. Of a damaged member the records before the damage count, and its end is where the next member or version line begins. An empty member is a separator."""
    plain, end, why = inflate(data, at)
    found = records_of(plain) if plain is not None else streamed(data, at)
    reasons, first = [], None
    for r in found:
        if isinstance(r, Record):
            first = r
            break
        reasons.append(r[2])
    if first is None and (why or reasons):
        return why or reasons[0]
    if why:
        following = START.search(data, at + 1)
        while following and not whole_at(data, following.start()):
            following = START.search(data, following.start() + 1)
        end = following.start() if following else len(data)

    def held() -> Iterator[Record | tuple[int, int, str]]:
        r = first
        while r is not None:
            if isinstance(r, Record):
                r.start, r.end = at, end
                yield r
            else:
                reasons.append(r[2])
            r = next(found, None)
        if why or reasons:
            yield at, end, why or f"within the member: {reasons[0]}"

    return held(), end


def whole_at(data: bytes, at: int) -> bool:
    """Whether a record or a whole member begins at a place."""
    if not data.startswith(MEMBER, at):
        return not isinstance(parse_record(data, at), str)
    plain, _, why = inflate(data, at)
    return not why and (plain == b"" or any(isinstance(r, Record) for r in (records_of(plain) if plain is not None else streamed(data, at))))


def records_of(data: bytes) -> Iterator[Record | tuple[int, int, str]]:
    """Plain records and the gaps between them: after a failed check the search goes on for a version line from which a whole record passes all checks."""
    at, bad, why = 0, -1, ""
    while at < len(data):
        found = parse_record(data, at)
        if isinstance(found, Record):
            if bad >= 0:
                yield bad, at, why
                bad = -1
            at = found.end  # before a caller tells where its member lies
            yield found
            continue
        if bad < 0:
            bad, why = at, found
        following = VERSION.search(data, at + 1)
        at = following.start() if following else len(data)
    if bad >= 0:
        yield bad, len(data), why


def salvage(data: bytes) -> Iterator[Record | tuple[int, int, str]]:
    """Records of an archive, plain or of gzip members, and a (start, end, reason) for each stretch of bytes without one.

    After a failed check the search goes on for a version line or member from which a whole record passes all checks, so that
    such bytes inside a payload don't mislead it. Of a member that is cut short or damaged the records that can still be
    read count, and the member is logged as a gap too. No bytes raise an error.
    """
    at, bad, why = 0, -1, ""
    while at < len(data):
        found: Iterator[Record | tuple[int, int, str]] | str
        if data.startswith(MEMBER, at):
            member = parse_member(data, at)
            found, end = (member, at) if isinstance(member, str) else member
        else:
            record = parse_record(data, at)
            found, end = (record, at) if isinstance(record, str) else (iter([record]), record.end)
        if not isinstance(found, str):
            if bad >= 0:
                yield bad, at, why
                bad = -1
            yield from found
            at = end
            continue
        if bad < 0:
            bad, why = at, found
        following = START.search(data, at + 1)
        at = following.start() if following else len(data)
    if bad >= 0:
        yield bad, len(data), why


def read_warc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Rows of all archives below path: file, start, end, kind (record or gap), reason (of a gap), record_type, record_id, target_uri,
    refers_to, payload_bytes, payload_digest and payload (binary; null unless asked for, and for revisits).

    payload_digest is computed for records with a payload; a revisit has what its headers say. Archives are read whole, one at a
    time, so each must fit a worker's memory (the writer bounds its files by bytes). An empty archive gives no row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, data in zip(batch.column("path").to_pylist(), batch.column("content")):
                out, held = [], 0
                for r in salvage(data.as_py()):
                    if isinstance(r, tuple):
                        out.append((path, r[0], r[1], "gap", r[2], None, None, None, None, None, None, None))
                        continue
                    h = r.headers
                    if revisit := h.get("warc-type") == "revisit":
                        told = re.search(rb"(?im)^content-length:[ \t]*([0-9]{1,18})\r?$", r.block)
                        size, digest, payload = int(told[1]) if told else None, h.get("warc-payload-digest", "").rpartition(":")[2].lower() or None, None
                    else:
                        payload = payload_of(r)
                        size, digest = len(payload), hashlib.sha1(payload).hexdigest()
                    out.append((path, r.start, r.end, "record", None, h.get("warc-type"), h.get("warc-record-id"), h.get("warc-target-uri"), h.get("warc-refers-to"), size, digest, payload if payloads and not revisit else None))
                    held += len(payload or b"") if payloads else 0
                    if len(out) == 1000 or held > 1 << 24:
                        yield rows_of(out)
                        out, held = [], 0
                yield rows_of(out)

    text, number = pa.string(), pa.int64()
    columns = {"file": text, "start": number, "end": number, "kind": text, "reason": text, "record_type": text, "record_id": text, "target_uri": text, "refers_to": text, "payload_bytes": number, "payload_digest": text, "payload": pa.binary()}

    def rows_of(rows: list[tuple]) -> pa.RecordBatch:
        return made(**{n: pa.array([r[k] for r in rows], kind) for k, (n, kind) in enumerate(columns.items())})

    schema = "file string, start long, end long, kind string, reason string, record_type string, record_id string, target_uri string, refers_to string, payload_bytes long, payload_digest string, payload binary"
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(path)
    return in_arrow(files.select("path", "content"), run, schema)
