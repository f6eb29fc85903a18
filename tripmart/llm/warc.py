"""Web archives: a writer of WARC files and a salvage reader.

The writer makes each record a gzip member of its own. The reader takes archives
of any writer: all record types, header names in any case, members of one or
several records. It checks every record: the member's checksum, the version line,
the headers, the length, and block and payload digests that are there in a known
algorithm. When a check fails it searches for the next valid member, or the next
version line in a file that is not compressed, goes on there, and logs the bytes
in between as a quarantined gap.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime, timedelta

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_path
from .common import saved

FILE_BYTES = 16 << 20      # a file of the writer is closed beyond this
MIN_REVISIT = 100          # bytes of a payload that is worth a revisit record
GZIP = b"\x1f\x8b\x08"
VERSION = b"WARC/"
_STEP = 16 << 10            # bytes given to the decompressor at once
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_LINE = re.compile(rb"WARC/(?:0\.1[78]|1\.[01])\r\n")
_NAME = re.compile(r"[!#$%&'*+.^_`|~0-9A-Za-z-]+")
_CHUNK = re.compile(rb"([0-9A-Fa-f]+)[^\r\n]*\r\n")
_HASHES = {"md5", "sha1", "sha224", "sha256", "sha384", "sha512"}
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _uri(page: int | None, digest: str, apart: bool) -> str:
    """The name of a record; ``apart`` makes it one of its own also among rows
    with the same id and payload."""
    own = f":{uuid.uuid4().hex}" if apart else ""
    return f"<urn:page:{'null' if page is None else page}:{digest}{own}>"


def _page(uri: str) -> int | None:
    m = re.fullmatch(r"<urn:page:(-?\d+)(?::[0-9a-f]{64})?(?::[0-9a-f]{32})?>", uri, re.ASCII)
    return int(m[1]) if m and -1 << 63 <= int(m[1]) < 1 << 63 else None


def record(page: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None,
           date: int | None = None, named: bool = False) -> bytes:
    """A response, or a revisit (without its payload) of ``refers_to``. ``date`` is
    that of the capture in seconds of Unix time (null, or beyond the years 1 to
    9999: the time of writing). The record that others refer
    to is ``named`` by its id and payload alone; others have names of their own."""
    block = _HTTP + (payload if refers_to is None else b"")
    when = datetime.now(UTC) if date is None or not -62135596800 <= date < 253402300800 \
        else datetime(1970, 1, 1, tzinfo=UTC) + timedelta(seconds=date)
    head = [("WARC-Type", "response" if refers_to is None else "revisit"),
            ("WARC-Record-ID", _uri(page, digest, not named)), ("WARC-Date", when.strftime("%Y-%m-%dT%H:%M:%SZ").rjust(20, "0")),
            ("WARC-Target-URI", re.sub(r"[\r\n]", " ", url or "")),
            ("WARC-Payload-Digest", f"sha256:{digest}"), ("X-Payload-Length", str(len(payload))),
            ("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    if refers_to is not None:
        head += [("WARC-Refers-To", _uri(refers_to, digest, False)), ("WARC-Profile", _PROFILE)]
    lines = "".join(f"{k}: {v}\r\n" for k, v in head).encode()
    return b"WARC/1.1\r\n" + lines + b"\r\n" + block + b"\r\n\r\n"


def member(raw: bytes) -> bytes:
    c = zlib.compressobj(6, zlib.DEFLATED, 31)
    return c.compress(raw) + c.flush()


def _headers(data: bytes) -> dict | None:
    """Header values by lower-case name, without the one space that follows the
    colon; None if a line is no header."""
    head: dict = {}
    name = None
    for line in data.decode().split("\r\n"):
        if line[:1] in (" ", "\t") and name:  # goes on with the line before
            head[name] += " " + line.strip(" \t")
            continue
        name, colon, value = line.partition(":")
        if not colon or not _NAME.fullmatch(name):
            return None
        name = name.lower()
        head[name] = value.removeprefix(" ")
    return head


def _digest(stated: str) -> tuple[str, str]:
    """Algorithm, if it is a known one, and value of a digest header."""
    kind, _, value = stated.strip(" \t").partition(":")
    kind = kind.lower().replace("-", "")
    return (kind, value) if kind in _HASHES else ("", "")


def _agrees(stated: str, *contents: bytes) -> bool:
    """Is the digest that of one of ``contents``? Values are in base 16, 32 or 64;
    one of an unknown algorithm is not checked."""
    kind, value = _digest(stated)
    for content in contents if kind else ():
        own = hashlib.new(kind, content).digest()
        if (value.lower() == own.hex() or value.upper().rstrip("=") == base64.b32encode(own).decode().rstrip("=")
                or value.rstrip("=") == base64.b64encode(own).decode().rstrip("=")):
            return True
    return not kind


def _dechunked(body: bytes) -> bytes | None:
    """The content of a body in HTTP chunks; None if it is not whole."""
    out, at = [], 0
    while m := _CHUNK.match(body, at):
        size, at = int(m[1], 16), m.end()
        if not size:
            return b"".join(out)
        if body[at + size:at + size + 2] != b"\r\n":
            return None
        out.append(body[at:at + size])
        at += size + 2
    return None


def parse(data: bytes, at: int = 0) -> tuple[dict, int] | None:
    """The record that begins at ``at`` and where it ends; None if any check fails.

    The payload of a response is the body of its HTTP message, that of any other
    type its block; a revisit has none. ``payload_digest`` is a SHA-256 in
    lower-case hex, any other as stated; null if there is none, as is
    ``payload_bytes`` of a revisit that does not tell it."""
    m = _LINE.match(data, at)
    end = data.find(b"\r\n\r\n", at) if m else -1
    if end < 0:
        return None
    try:
        head = _headers(data[m.end():end])
        kind = head["warc-type"].strip(" \t").lower()
        size = head["content-length"].strip(" \t")
        length = int(head["x-payload-length"]) if "x-payload-length" in head else None
    except (ValueError, KeyError, TypeError):
        return None
    if not kind or not re.fullmatch("[0-9]{1,18}", size) or not 0 <= (length or 0) < 1 << 63:
        return None
    size = int(size)
    block, after = data[end + 4:end + 4 + size], end + 4 + size
    if len(block) < size or data[after:after + 4] != b"\r\n\r\n":
        return None
    http = block.find(b"\r\n\r\n") if block.startswith(b"HTTP/") or "http" in head.get("content-type", "").lower() \
        else -1
    body = block[http + 4:] if http >= 0 else block
    payload = None if kind == "revisit" else body if kind == "response" else block
    stated = head.get("warc-payload-digest")
    # A revisit states the digest of the record it refers to, a segment may state that of the whole.
    if stated is not None and kind != "revisit" and "warc-segment-number" not in head:
        chunked = _dechunked(body) if b"chunked" in block[:max(http, 0)].lower() else None
        if not _agrees(stated, body, *([] if chunked is None else [chunked])):
            return None
    if "warc-block-digest" in head and not _agrees(head["warc-block-digest"], block):
        return None
    if kind == "response" and length not in (None, len(body)):
        return None
    if stated is not None:
        name, value = _digest(stated)
        stated = stated.strip(" \t")
        if name == "sha256":
            stated = value.lower() if len(value) == 64 else stated
            if len(value.rstrip("=")) == 52:
                stated = base64.b32decode(value.upper().rstrip("=") + "====").hex()
    url = head.get("warc-target-uri")
    return {"page_id": _page(head.get("warc-record-id", "").strip(" \t")), "record_type": kind,
            "payload_digest": stated,
            "payload_bytes": length if length is not None or payload is None else len(payload),
            "refers_to": _page(head.get("warc-refers-to", "").strip(" \t")),
            # This module's own urls may begin or end with blanks.
            "date": head["warc-date"].strip(" \t") if "warc-date" in head else None,
            "url": url if url is None or length is not None else url.strip(" \t"), "payload": payload}, after + 4


def _records(raw: bytes) -> tuple[list[dict], bool]:
    """All valid records of an inflated member, and whether they are all of it."""
    out, at, whole = [], 0, True
    while at < len(raw):
        one = parse(raw, at)
        if one:
            out.append(one[0])
            at = one[1]
            continue
        whole, at = False, raw.find(VERSION, at + 1)
        if at < 0:
            break
    return out, whole


def _inflate(data: bytes, at: int) -> tuple[bytes, int] | None:
    """The gzip member at ``at`` and where it ends; None if it is damaged."""
    d, out = zlib.decompressobj(31), []
    try:
        for i in range(at, len(data), _STEP):
            out.append(d.decompress(data[i:i + _STEP]))
            if d.eof:
                return b"".join(out), min(i + _STEP, len(data)) - len(d.unused_data)
    except zlib.error:
        pass
    return None


def salvage(data: bytes) -> Iterator[tuple[int, int, dict | None]]:
    """``(start, end, record)`` over a whole file; a gap has no record. Every
    byte is in exactly one of them: of several records of a gzip member the first
    has the member's bytes, the others none of their own. A member that inflates
    but holds more than its valid records is a gap, followed by those records."""
    at, gap = 0, None
    while at < len(data):
        found, whole, end = [], True, at
        if data.startswith(GZIP, at):
            got = _inflate(data, at)
            if got:
                found, whole = _records(got[0])
                end = got[1]
        elif data.startswith(VERSION, at):
            one = parse(data, at)
            if one:
                found, end = [one[0]], one[1]
        if found:
            if not whole:
                yield at if gap is None else gap, end, None
                at = end
            elif gap is not None:
                yield gap, at, None
            gap = None
            for record_ in found:
                yield at, end, record_
                at = end
            continue
        gap = at if gap is None else gap
        after = [x for x in (data.find(GZIP, at + 1), data.find(VERSION, at + 1)) if x >= 0]
        at = min(after, default=len(data))
    if gap is not None:
        yield gap, len(data), None


def _write(folder: str):
    def run(batches):
        from pyarrow import fs
        store, base = fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") \
            else (fs.LocalFileSystem(), folder)
        store.create_dir(base, recursive=True)
        done: list[tuple[str, int, int]] = []
        out, name, size, count = None, "", 0, 0

        def close():
            nonlocal out
            if out:
                out.close()
                done.append((name, size, count))
                out = None

        for batch in batches:
            for page, url, html, digest, refers, date, named in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    # A new name for each attempt: what a lost task left is in no manifest.
                    name, size, count = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = store.open_output_stream(f"{base}/{name}", compression=None)
                raw = member(record(page, url, (html or "").encode(), digest, refers, date, named))
                out.write(raw)
                size, count = size + len(raw), count + 1
                if size > FILE_BYTES:
                    close()
        close()
        yield pa.RecordBatch.from_pylist(
            [{"file": f, "bytes": b, "records": n} for f, b, n in done],
            pa.schema([("file", pa.string()), ("bytes", pa.int64()), ("records", pa.int64())]))
    return run


def write_warc(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
               html_col: str = "html", date_col: str | None = None) -> DataFrame:
    """Archive ``pages`` under ``folder`` (on storage that all executors share);
    returns the manifest ``(file, bytes, records)`` of the files that count.

    A payload is the page's html in UTF-8 (null: empty). Of equal payloads of
    ``MIN_REVISIT`` bytes or more the one with the smallest id is a response, the
    others (larger ids) revisit it. Repeated rows with that id are responses too;
    rows with a null id are responses and are referred to by none. Null urls are
    empty. An empty table writes no file. ``date_col`` holds the times of capture
    (null, no time, or no column given: the time of writing). Record names are unique but for
    repeated rows of a record that is referred to, which is one record twice.

    Payloads are compared by SHA-256 in a narrow table; only digests of several
    pages reach the join, whose skewed keys AQE splits. Pages are read once more
    and written where they are.
    """
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    digest = F.sha2(html, 256)
    page = F.col(id_col).cast("long")
    long_ = pages.where((F.octet_length(html) >= MIN_REVISIT) & page.isNotNull())
    same = saved(long_.groupBy(digest.alias("digest")).agg(F.min(page).alias("first"), F.max(page).alias("last"))
                 .where("first < last").select("digest", "first"), "payloads")
    date = F.unix_timestamp(F.col(date_col).try_cast("timestamp")) if date_col else F.lit(None).cast("long")
    rows = pages.select(page.alias("page"), F.col(url_col).cast("string").alias("url"), html.alias("html"),
                        digest.alias("digest"), date.alias("date"))
    placed = rows.join(same, "digest", "left").select(
        "page", "url", "html", "digest", F.when(F.col("page") > F.col("first"), F.col("first")).alias("refers"),
        "date", F.coalesce(F.col("page") == F.col("first"), F.lit(False)).alias("named"))
    return saved(placed.mapInArrow(_write(folder), "file string, bytes long, records long"), "manifest")


_RECORD = ("page_id long, record_type string, payload_digest string, payload_bytes long, refers_to long, "
           "url string, date string, payload binary, file string, gap_start long, gap_end long")


def _read(batches):
    names = [x.split()[0] for x in _RECORD.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    schema = pa.schema([(x.split()[0], kinds[x.split()[1]]) for x in _RECORD.split(", ")])
    for batch in batches:
        for i in range(batch.num_rows):
            file, rows, held = batch.column(0)[i].as_py(), [], 0
            for start, end, got in salvage(batch.column(1)[i].as_py()):
                row = dict.fromkeys(names) | (got or {"gap_start": start, "gap_end": end}) | {"file": file}
                rows.append(row)
                held += len(row["payload"] or b"")
                if held > 4 << 20:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows, held = [], 0
            yield pa.RecordBatch.from_pylist(rows, schema)


def read_warc(spark: SparkSession, folder: str, manifest: DataFrame | None = None) -> DataFrame:
    """All records and quarantined gaps of the WARC files under ``folder``, of
    those in ``manifest`` only if one is given. A gap is a row with
    ``gap_start`` and ``gap_end`` (bytes of ``file``) and no record."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.warc*").load(folder)
             .select(F.element_at(F.split("path", "/"), -1).alias("file"), "content"))
    if manifest is not None:
        files = files.join(manifest.select("file"), "file", "left_semi")
    return files.select("file", "content").mapInArrow(_read, _RECORD)


def archive(pages: DataFrame) -> DataFrame:
    """Write ``pages`` as WARC files in the shared folder and read them back."""
    spark = pages.sparkSession
    folder = shared_path(spark, "llm", "warc")
    manifest = write_warc(pages, folder)
    if not manifest.select(F.sum("records")).first()[0]:
        return spark.createDataFrame([], _RECORD)
    return read_warc(spark, folder, manifest)
