"""Legacy archive converter: ARC files to WARC 1.1 files, and both back to rows.

An ARC file starts with a version block, whose second line names the version; every record is one header
line, whose fields depend on that version, followed by as many bytes as its last field declares and a
line feed. Version 1 has URL, IP address, date, type and length; version 2 has result code, checksum,
location, offset and file name before the length. Types may hold blanks, so fields are counted from
both ends. A damaged header or a length that runs past the end becomes a row with ``error`` and the
reading goes on at the next line that looks like a header.

Every file begins with a ``warcinfo`` record made from the version block. The other records are made from what the ARC
records say: an identifier by name-based UUID over the ARC file's name, the record's number there, URL, date and digest,
so a repeated run gives the same one and no two records share one; the 14-digit date as an ISO timestamp; the type by
the URL's scheme (``dns:`` is a ``resource``, all else a ``response``). A body that begins with an HTTP head is split:
head and payload are the block, ``application/http``, and the payload alone has the payload digest; the block digest
covers both. Of records with equal payloads of at least ``SHARED`` bytes the one with the smallest key is ``response``,
the others are ``revisit`` records that refer to its identifier, URL and date and carry the HTTP head at most.

Files are written by Spark's text writer with its commit protocol: the end of a record is the line
separator, and every file holds whole records. A file has about ``FILE_BYTES`` of payload, so a task holds
one file and at most one record more; files that others wrote are read whole, up to Spark's 2 GB a value. Payloads are never shuffled uncompressed: the digests decide which
records are revisits, and a file meets the list of its own. Files are gzip-compressed, as one member.

Defined results: a null payload is empty; a null URL is written as ``-``; blanks and control characters in
URLs become %20; the page's key travels in the URL's fragment; repeated rows give a record each, and of
equal payloads under one key one is the response; empty tables give no files and no rows.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acreline.llm.common import written

SHARED, FILE_BYTES = 100, 16 << 20
ARC_END, WARC_END = "\n", "\r\n\r\n"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
#: Fields of a header line before and after the type, by version.
ARC_FIELDS = {1: (("url", "ip", "date"), ("length",)), 2: (("url", "ip", "date"), ("code", "checksum", "location", "offset", "filename", "length"))}
_NAMES = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
_HEADER = re.compile(rb"\n(?=\S+ \S+ \d{14} [^\n]* \d+\n)")


# --- writing ---------------------------------------------------------------------------------


def _write(rows: DataFrame, path: str, end: str) -> None:
    """``rows(archive, n, record)``: a folder per archive with one file, its records in the order of ``n``.
    Every archive lies in one partition, so nothing is shuffled."""
    laid = rows.sortWithinPartitions("archive", "n").select("archive", "record")
    laid.write.partitionBy("archive").option("lineSep", end).option("compression", "gzip").text(path)


_OUT, _OUT_SCHEMA = pa.schema([("archive", pa.string()), ("n", pa.int64()), ("record", pa.string())]), "archive string, n bigint, record string"


def _batched(rows: Iterator[tuple[int, dict]], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Batches of about 8 MB from (size, row) pairs."""
    held, size = [], 0
    for n, row in rows:
        held.append(row)
        size += n
        if size > 8 << 20:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def version_block(name: str, version: int, date: str) -> str:
    body = f"{version} 0 acreline\n{_NAMES[version]}\n"
    more = "" if version == 1 else f"200 - - 0 {name} "
    return f"filedesc://{name} 0.0.0.0 {date} text/plain {more}{len(body)}\n{body}"


def arc_record(link: str, html: bytes, name: str, version: int, date: str) -> str:
    more = "" if version == 1 else f"200 {hashlib.md5(html).hexdigest()} - 0 {name} "
    return f"{link} 0.0.0.0 {date} text/html {more}{len(HTTP) + len(html)}\n{HTTP}{html.decode()}"


def write_arc(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", payload: str = "html", version: Column | None = None, date: str = "20200101000000") -> None:
    """ARC files of ``pages``. ``version`` (1 or 2) may differ by row; each archive has one version. A task
    fills archives of its own up to ``FILE_BYTES``, one open per version."""
    rows = pages.select(
        (version if version is not None else F.lit(1)).cast("int").alias("v"),
        F.coalesce(F.col(key).cast("string"), F.lit("-")).alias("k"), F.col(url).cast("string").alias("u"), F.col(payload).alias("h"),
    )

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, filled, used = TaskContext.get().partitionId(), {1: 0, 2: 0}, {1: FILE_BYTES, 2: FILE_BYTES}

        def lines():
            n = 0
            for batch in batches:
                for v, k, u, h in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), batch.column(3).cast(pa.large_binary())):
                    html, link = h.as_py() or b"", re.sub(r"[\x00-\x20]", "%20", u.as_py() or "") or "-"
                    if used[v] >= FILE_BYTES:
                        filled[v], used[v] = filled[v] + 1, 0
                        name = f"v{v}-{task}-{filled[v]}.arc"
                        yield 200, {"archive": name, "n": -1, "record": version_block(name, v, date)}
                    name = f"v{v}-{task}-{filled[v]}.arc"
                    used[v] += len(html)
                    n += 1
                    # the key travels in the URL's fragment, which a crawler never sends
                    yield len(html), {"archive": name, "n": n, "record": arc_record(f"{link}#key={k.as_py()}", html, name, v, date)}

        return _batched(lines(), _OUT)

    _write(rows.mapInArrow(fill, _OUT_SCHEMA), path, ARC_END)


# --- reading ARC -----------------------------------------------------------------------------


def arc_version(data: bytes) -> int:
    """The number in the second line of the version block."""
    end = data.find(b"\n")
    version = data[end + 1 : data.find(b"\n", end + 1)].split(b" ")[0]
    return int(version) if version.isdigit() else 1


def parse_arc(data: bytes) -> Iterator[dict]:
    """Records of one ARC file after its version block."""
    version = arc_version(data)
    if version not in ARC_FIELDS or not data.startswith(b"filedesc://"):
        yield {"error": "no version block"}
        return
    before, after = ARC_FIELDS[version]
    at, opening = 0, True
    while at < len(data):
        end = data.find(b"\n", at)
        line = data[at : end if end >= 0 else len(data)]
        if not line.strip():
            at = end + 1 if end >= 0 else len(data)
            continue
        fields = line.split(b" ")
        # the version block's own header always has the type, and the fields of its version
        n = len(before) + 1 + len(after)
        sound = len(fields) >= n and fields[-1].isdigit() and end + 1 + int(fields[-1]) <= len(data)
        if not sound:
            yield {"error": "header or length", "url": line[:200].decode("utf-8", "replace")}
            found = _HEADER.search(data, end if end >= 0 else len(data))
            at = found.end() if found else len(data)
            continue
        row = dict(zip(before, fields)) | dict(zip(after, fields[-len(after) :]))
        size = int(row["length"])
        body = data[end + 1 : end + 1 + size]
        at = end + 1 + size
        if opening:
            opening = False
            continue
        kind = b" ".join(fields[len(before) : len(fields) - len(after)])
        yield {
            "url": row["url"].decode("utf-8", "replace"), "ip": row["ip"].decode("utf-8", "replace"), "date": row["date"].decode("utf-8", "replace"),
            "type": kind.decode("utf-8", "replace"), "version": version, "payload": body, "error": None,
        }


_ARC = pa.schema([("path", pa.string()), ("n", pa.int64()), ("url", pa.string()), ("ip", pa.string()), ("date", pa.string()), ("type", pa.string()), ("version", pa.int32()), ("payload", pa.binary()), ("error", pa.string())])
ARC_SCHEMA = "path string, n bigint, url string, ip string, date string, type string, version int, payload binary, error string"


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")


def _opened(name: str, data: bytes) -> bytes:
    return gzip.decompress(data) if name.endswith(".gz") else data


def _rows(parse, schema: pa.Schema):
    """One file in memory at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = enumerate(parse(_opened(name, content.as_py())))
                yield from _batched(((len(row.get("payload") or b""), {"path": name, "n": n} | row) for n, row in found), schema)

    return run


def read_arc(spark: SparkSession, path: str) -> DataFrame:
    """A row per record of all ARC files below ``path``; damaged places are rows with ``error``."""
    return _files(spark, path).mapInArrow(_rows(parse_arc, _ARC), ARC_SCHEMA)


# --- converting ------------------------------------------------------------------------------

_HTTP = re.compile(rb"HTTP/[0-9.]+ [^\r\n]*\r?\n(?:[^\r\n]+\r?\n)*\r?\n")


def split_http(body: bytes) -> tuple[bytes, bytes]:
    """(HTTP head with its empty line, payload); no head, all payload."""
    m = _HTTP.match(body)
    return (body[: m.end()], body[m.end() :]) if m else (b"", body)


_KEY = re.compile(r"#key=(?:-|(-?[0-9]+))$")
_META = pa.schema([("path", pa.string()), ("n", pa.int64()), ("key", pa.int64()), ("url", pa.string()), ("date", pa.string()), ("bytes", pa.int64()), ("digest", pa.string())])
_META_SCHEMA = "path string, n bigint, key bigint, url string, date string, bytes bigint, digest string"


def _target(row: dict) -> tuple[int | None, str, str]:
    """Key, URL and ISO date of an ARC row; a date that is none becomes the start of 1970."""
    m = _KEY.search(row["url"])
    d = row["date"]
    iso = f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z" if re.fullmatch(r"[0-9]{14}", d) else "1970-01-01T00:00:00Z"
    return (int(m.group(1)) if m and m.group(1) else None), _KEY.sub("", row["url"]), iso


def _meta(data: bytes) -> Iterator[dict]:
    for row in parse_arc(data):
        if row["error"] is None:
            key, url, date = _target(row)
            payload = split_http(row["payload"])[1]
            yield {"key": key, "url": url, "date": date, "bytes": len(payload), "digest": hashlib.sha256(payload).hexdigest()}
        else:
            yield {}  # keeps the numbering


def revisits(spark: SparkSession, path: str) -> DataFrame:
    """(path, n, first): the records of the ARC files that repeat an earlier payload, and the record
    they refer to. Payloads stay in their tasks; only digests are shuffled."""
    meta = written(_files(spark, path).mapInArrow(_rows(_meta, _META), _META_SCHEMA).filter("digest is not null"), "arc-records")
    order = F.struct(F.col("key").isNull().alias("lone"), "key", "url", "path", "n", "date")
    firsts = meta.filter(F.col("bytes") >= SHARED).groupBy(F.col("digest").alias("d"))
    firsts = firsts.agg(F.count("*").alias("copies"), F.min(order).alias("first")).filter("copies > 1")
    later = meta.join(firsts, F.col("digest") == F.col("d")).filter((F.col("path") != F.col("first.path")) | (F.col("n") != F.col("first.n")))
    return later.select("path", "n", F.struct("first.path", "first.n", "first.key", "first.url", "first.date").alias("first"))


def record_id(path: str, n: int, key: int | None, url: str, date: str, digest: str) -> str:
    """``path`` is that of the ARC file below the folder that is converted, ``n`` the record's number there."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{path} {n} {url} {date} {digest} {key}')}>"


def _record(head: list[str], block: bytes) -> str:
    lines = [*head, f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines) + "\r\n\r\n" + block.decode("utf-8", "replace")


def info_record(path: str, archive: str, version: int) -> str:
    """The record that a file begins with: what it is and where it comes from."""
    fields = f"software: acreline\r\nformat: WARC File Format 1.1\r\ndescription: converted from ARC version {version}\r\n"
    date = "1970-01-01T00:00:00Z"
    head = ["WARC/1.1", "WARC-Type: warcinfo", f"WARC-Record-ID: {record_id(path, -1, None, archive, date, '')}", f"WARC-Date: {date}"]
    return _record([*head, f"WARC-Filename: {archive}", "Content-Type: application/warc-fields"], fields.encode())


def warc_record(row: dict, path: str, n: int, refers_to: dict | None) -> str:
    key, url, date = _target(row)
    http, body = split_http(row["payload"])
    digest = hashlib.sha256(body).hexdigest()
    plain = "resource" if url.lower().startswith("dns:") else "response"
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if refers_to else plain}",
        f"WARC-Record-ID: {record_id(path, n, key, url, date, digest)}",
        f"WARC-Target-URI: {url}",
        f"WARC-Date: {date}",
        f"WARC-IP-Address: {row['ip']}",
        f"WARC-Payload-Digest: sha256:{digest}",
    ]
    if refers_to:
        head += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {record_id(**refers_to, digest=digest)}",
            f"WARC-Refers-To-Target-URI: {refers_to['url']}",
            f"WARC-Refers-To-Date: {refers_to['date']}",
            f"X-Refers-To-Key: {'-' if refers_to['key'] is None else refers_to['key']}",
        ]
    kind = "application/http;msgtype=response" if http else row["type"]
    head += [f"X-Key: {'-' if key is None else key}", f"X-Payload-Length: {len(body)}", f"Content-Type: {kind}"]
    return _record(head, http if refers_to else http + body)


def _below(name: str, folder: str) -> str:
    """A file's path below the folder that was read, whatever scheme either is written with."""
    inside = folder.rstrip("/").split("://")[-1].lstrip("/") + "/"
    return name.split(inside, 1)[-1]


def convert(spark: SparkSession, arc_path: str, warc_path: str) -> None:
    """A WARC file for every ARC file. The list of a file's revisits meets the file as one row; payloads that
    are not UTF-8 would need a binary writer, which Spark has not: their broken bytes are replaced."""
    again = revisits(spark, arc_path).groupBy(F.col("path").alias("p")).agg(F.collect_list(F.struct("n", "first")).alias("again"))
    files = _files(spark, arc_path).join(again, F.col("path") == F.col("p"), "left").select("path", "content", "again")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content, again in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                refers = {x["n"]: x["first"] | {"path": _below(x["first"]["path"], arc_path)} for x in again.as_py() or ()}
                archive = name.rstrip("/").split("/")[-2].removeprefix("archive=").removesuffix(".arc") + ".warc"
                data, place = _opened(name, content.as_py()), _below(name, arc_path)
                found = ((n, row) for n, row in enumerate(parse_arc(data)) if row["error"] is None)
                rows = ((len(row["payload"]), {"archive": archive, "n": n, "record": warc_record(row, place, n, refers.get(n))}) for n, row in found)
                first = (0, {"archive": archive, "n": -1, "record": info_record(place, archive, arc_version(data))})
                yield from _batched(chain([first], rows), _OUT)

    _write(files.mapInArrow(build, _OUT_SCHEMA), warc_path, WARC_END)


_WARC = pa.schema([("path", pa.string()), ("type", pa.string()), ("record_id", pa.string()), ("refers_to_id", pa.string()), ("url", pa.string()), ("date", pa.string()), ("key", pa.int64()), ("refers_to", pa.int64()), ("bytes", pa.int64()), ("digest", pa.string()), ("payload", pa.binary()), ("error", pa.string())])
WARC_SCHEMA = "path string, type string, record_id string, refers_to_id string, url string, date string, key bigint, refers_to bigint, bytes bigint, digest string, payload binary, error string"


def parse_warc(data: bytes) -> Iterator[dict]:
    """Records of one WARC file; blocks and payloads are checked against their digests."""
    at = 0
    number = lambda x: int(x) if x is not None and x.lstrip("-").isdigit() else None
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8", "replace").split("\r\n")
        head = dict(x.split(": ", 1) for x in lines[1:] if ": " in x)
        size = head.get("Content-Length", "")
        if end < 0 or not lines[0].startswith("WARC/") or not size.isdigit() or end + 4 + int(size) > len(data):
            yield {"error": f"damaged record at byte {at}"}
            return
        block = data[end + 4 : end + 4 + int(size)]
        body = split_http(block)[1] if head.get("Content-Type", "").startswith("application/http") else block
        digest = head.get("WARC-Payload-Digest", "").removeprefix("sha256:")
        whole = head.get("WARC-Block-Digest", "").removeprefix("sha256:")
        bad = bool(whole) and hashlib.sha256(block).hexdigest() != whole
        bad |= head.get("WARC-Type") in ("response", "resource") and hashlib.sha256(body).hexdigest() != digest
        yield {
            "type": head.get("WARC-Type"), "record_id": head.get("WARC-Record-ID"), "refers_to_id": head.get("WARC-Refers-To"), "url": head.get("WARC-Target-URI"), "date": head.get("WARC-Date"),
            "key": number(head.get("X-Key")), "refers_to": number(head.get("X-Refers-To-Key")), "bytes": number(head.get("X-Payload-Length")),
            "digest": digest, "payload": body, "error": "digest" if bad else None,
        }
        at = end + 4 + int(size) + len(WARC_END)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    return _files(spark, path).mapInArrow(_rows(parse_warc, _WARC), WARC_SCHEMA)
