"""WARC archives of crawled pages, and a reader that salvages damaged ones.

Writer: one gzip member per record, archives of a bounded size.  A payload that
occurs again is written once; later pages get ``revisit`` records that name the
payload's digest and the record that holds it.

Reader: every record is checked (gzip trailer, version line, Content-Length,
block end, digests).  After a failed check the reader looks for the next gzip
member or version line at which a whole valid record starts, also inside a
member, goes on from there, and logs the bytes in between as a quarantined gap.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refinery.llm.store import new_file
from refinery.session import materialize, scratch_path

ARCHIVE_BYTES = 8 << 20
# Fixed values of the WARC 1.1 format.
VERSION = b"WARC/1.1"
MEMBER = b"\x1f\x8b\x08"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "path string, records long, bytes long"
RECORDS = ("path string, start long, end long, reason string, record_type string, record_id string, url string, "
           "payload_digest string, payload_bytes long, refers_to string, payload binary")


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# --- writing -------------------------------------------------------------------------------------

def record_urn(page_id) -> str:
    return f"<urn:page:{'' if page_id is None else quote(str(page_id), safe='')}>"


def record_bytes(page_id, url, payload: bytes, digest: str, refers_to, revisit: bool, date: str) -> bytes:
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    http += b"\r\n" if revisit else b"Content-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_urn(page_id)), ("WARC-Date", date)]
    if url is not None:
        head.append(("WARC-Target-URI", quote(url, safe=":/?#[]@!$&'()*+,;=%~")))
    if revisit:
        head += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_urn(refers_to))]
    head += [("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"),
             ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    lines = "".join(f"{k}: {v}\r\n" for k, v in head).encode()
    return VERSION + b"\r\n" + lines + b"\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def write_archives(pages: DataFrame, folder: str, id_column: str = "page_id", url_column: str = "url",
                   html_column: str = "html", min_revisit_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES,
                   date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write one record per row under ``folder``; returns the manifest (path,
    records, bytes), which names the files of the attempts that count.

    Among rows with equal payloads of at least ``min_revisit_bytes`` bytes the
    one with the smallest id is the response and the others refer to it; a
    null id is larger than all others.  Rows that repeat both id and payload
    are all responses.  A null page is an empty payload, a null url is left
    out.  Other columns are not read."""
    html = F.coalesce(F.col(html_column), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_column).alias("id"), F.col(url_column).alias("url"), html.alias("payload"),
                        F.sha1(html).alias("sha1"))
    repeated = (rows.filter(F.octet_length("payload") >= min_revisit_bytes).groupBy("sha1")
                .agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"))
    repeated = materialize(repeated, "warc-repeated")
    marked = rows.join(repeated, "sha1", "left").withColumn(
        "revisit", F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("id")))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        made, held, records, size = [], [], 0, 0

        def close() -> None:
            nonlocal held, records, size
            if records:
                name = f"pages-{part:06d}-{len(made):04d}-{uuid.uuid4().hex[:8]}.warc.gz"
                with new_file(folder, name) as out:
                    for m in held:
                        out.write(m)
                made.append({"path": name, "records": records, "bytes": size})
                held, records, size = [], 0, 0

        for batch in batches:
            for i in range(batch.num_rows):
                page, url, body, sha1, first, revisit = (batch.column(c)[i].as_py() for c in
                                                         ("id", "url", "payload", "sha1", "first", "revisit"))
                digest = base64.b32encode(bytes.fromhex(sha1)).decode()
                held.append(member(record_bytes(page, url, body, digest, first, revisit, date)))
                records, size = records + 1, size + len(held[-1])
                if size >= archive_bytes:
                    close()
        close()
        yield pa.RecordBatch.from_pylist(made, pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]))

    return materialize(marked.mapInArrow(write, MANIFEST), "warc-manifest")


# --- reading -------------------------------------------------------------------------------------

class Damage(ValueError):
    """A record that fails a check."""


def inflate(data: memoryview, pos: int, step: int = 1 << 16) -> tuple[bytes, int, str | None]:
    """The gzip member at ``pos``, where it ends, and no reason; of a damaged
    or cut member what inflates before the damage, where that is, and the reason."""
    z, out, at = zlib.decompressobj(31), [], pos
    while not z.eof:
        if at >= len(data):
            return b"".join(out), len(data), "member is cut off"
        piece, before = data[at:at + step], z.copy() if at > pos else None
        try:
            out.append(z.decompress(piece))
        except zlib.error as e:
            z = before or zlib.decompressobj(31)
            for k in range(len(piece)):                   # byte by byte up to the damage
                try:
                    out.append(z.decompress(piece[k:k + 1]))
                except zlib.error:
                    return b"".join(out), at + k, f"bad member: {e}"
        at += len(piece)
    return b"".join(out), at - len(z.unused_data), None


def reach(data: memoryview, pos: int, size: int, step: int = 1 << 16) -> int:
    """Where the bytes end that give the first ``size`` of the member at ``pos``."""
    z, at = zlib.decompressobj(31), pos
    while size > 0:
        piece = data[at:at + step]
        size -= len(z.decompress(piece, size))
        at += len(piece) - len(z.unconsumed_tail)
    return at


def parse(data: bytes, pos: int) -> tuple[dict, bytes, int]:
    """Headers (lower-case names) and block of the record at ``pos``, and its
    end.  Headers may be of any length (a url has no bound)."""
    if not data.startswith(b"WARC/1.", pos):
        raise Damage("no version line")
    end = data.find(b"\r\n\r\n", pos)
    if end < 0:
        raise Damage("headers do not end")
    lines = data[pos:end].split(b"\r\n")[1:]
    head = {k.strip().lower(): v.strip() for k, _, v in (x.decode("utf-8", "replace").partition(":") for x in lines)}
    if not head.get("content-length", "").isdigit():
        raise Damage("no Content-Length")
    start = end + 4
    stop = start + int(head["content-length"])
    if data[stop:stop + 4] != b"\r\n\r\n":
        raise Damage("block does not end where Content-Length says")
    block = data[start:stop]
    if (want := head.get("warc-block-digest", "")).startswith("sha1:") and want[5:] != base32_sha1(block):
        raise Damage("block digest differs")
    payload = payload_of(head, block)
    if (want := head.get("warc-payload-digest", "")).startswith("sha1:") and head.get("warc-type") != "revisit" \
            and want[5:] != base32_sha1(payload):
        raise Damage("payload digest differs")
    return head, payload, stop + 4


def payload_of(head: dict, block: bytes) -> bytes:
    if "application/http" in head.get("content-type", ""):
        return block.partition(b"\r\n\r\n")[2]
    return block


def plain_spans(content: bytes) -> Iterator[tuple]:
    """``salvage`` over records that are not in gzip members."""
    pos, gap, reason = 0, None, ""
    while pos < len(content):
        try:
            head, payload, end = parse(content, pos)
        except Damage as e:
            if gap is None:
                gap, reason = pos, str(e)
            pos = content.find(b"WARC/1.", pos + 1)
            pos = len(content) if pos < 0 else pos
            continue
        if gap is not None:
            yield gap, pos, [], reason
            gap = None
        yield pos, end, [(head, payload)], None
        pos = end
    if gap is not None:
        yield gap, len(content), [], reason


def records_at(content: bytes, pos: int) -> tuple[list, int, str | None, str | None]:
    """The sound records of the gzip member at ``pos``, or the plain record
    there; where they end; what is wrong between them; and why the member goes
    no further.  The last record of a member without a valid trailer counts only
    if a version line follows."""
    if not content.startswith(MEMBER, pos):
        head, payload, end = parse(content, pos)
        return [(head, payload)], end, None, None
    data = memoryview(content)
    plain, end, broken = inflate(data, pos)
    spans = list(plain_spans(plain))
    if broken:
        if spans and not spans[-1][3]:
            spans.pop()
        while spans and spans[-1][3]:
            spans.pop()
        if not spans:
            raise Damage(broken)
        end = reach(data, pos, spans[-1][1] - 4)          # before the record's last line ends: no byte of what follows it
    found = [r for s in spans for r in s[2]]
    bad = [s for s in spans if s[3]]
    if bad and not found:
        raise Damage(bad[0][3])
    return found, end, "; ".join(f"{why} (inflated bytes {a} to {b})" for a, b, _, why in bad) or None, broken


def salvage(content: bytes) -> Iterator[tuple]:
    """(start, end, records, reason) over the bytes of an archive: records and
    no reason for a sound span, no records and the reason for a gap, both for a
    member with a damaged record beside sound ones.  Spans follow one another
    without holes and cover all bytes."""
    pos, gap, reason = 0, None, ""
    while pos < len(content):
        try:
            found, end, wrong, broken = records_at(content, pos)
        except Damage as e:
            if gap is None:
                gap, reason = pos, str(e)
            nexts = [n for n in (content.find(MEMBER, pos + 1), content.find(b"WARC/1.", pos + 1)) if n >= 0]
            pos = min(nexts, default=len(content))
            continue
        if gap is not None:
            if gap < pos:
                yield gap, pos, [], reason
            gap = None
        if broken and end == len(content):                # no bytes are left for a gap
            wrong = "; ".join(filter(None, (wrong, broken)))
        yield pos, end, found, wrong
        pos = end
        if broken and end < len(content):
            gap, reason = end, broken
    if gap is not None:
        yield gap, len(content), [], reason


def read_archives(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """Every record and every gap of the archives under ``folder``, one row
    each (``RECORDS``): a gap has a ``reason`` and no record type.  What is lost
    beside sound records of one gzip member is a row over that member.  An
    archive is one task's value; the writer bounds it."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content")):
                rows = []
                name = path.as_py().rsplit("/", 1)[-1]
                for start, end, found, reason in salvage(content.as_py()):
                    span = {"path": name, "start": start, "end": end}
                    rows += [span | _row(h, p, with_payload) for h, p in found]
                    rows += [span | {"reason": reason}] if reason or not found else []
                yield pa.RecordBatch.from_pylist(rows, _ARROW)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder).select("path", "content")
    return files.mapInArrow(read, RECORDS)


_ARROW = pa.schema([(n, {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[t])
                    for n, t in (x.split() for x in RECORDS.split(", "))])


def _urn(value: str | None) -> str | None:
    page = (value or "").removeprefix("<urn:page:").removesuffix(">")
    return unquote(page) if page else None


def _row(head: dict, payload: bytes, with_payload: bool) -> dict:
    revisit = head.get("warc-type") == "revisit"
    digest = head.get("warc-payload-digest", "").removeprefix("sha1:") if revisit else base32_sha1(payload)
    return {"record_type": head.get("warc-type"), "record_id": _urn(head.get("warc-record-id")),
            "url": head.get("warc-target-uri"), "payload_digest": digest, "payload_bytes": None if revisit else len(payload),
            "refers_to": _urn(head.get("warc-refers-to")), "payload": payload if with_payload else None}


def round_trip(pages: DataFrame, **options) -> DataFrame:
    """Write ``pages`` to fresh archives, read them back, and give each
    revisit the size of the payload that its digest names.  Archives of
    attempts that do not count are left out."""
    spark = pages.sparkSession
    folder = scratch_path(spark, "warc")
    manifest = write_archives(pages, folder, **options)
    if not manifest.take(1):
        return spark.createDataFrame([], RECORDS)
    found = read_archives(spark, folder, with_payload=False).join(manifest.select("path"), "path", "left_semi")
    found = materialize(found, "warc-read")
    size = (found.filter("record_type = 'response'").groupBy(F.col("payload_digest").alias("of"))
            .agg(F.max("payload_bytes").alias("held")))
    joined = found.join(size, (F.col("record_type") == "revisit") & (F.col("payload_digest") == F.col("of")), "left")
    return joined.withColumn("payload_bytes", F.coalesce("payload_bytes", "held")).drop("of", "held")
