"""WARC archives: a writer that stores equal payloads once, and a salvage reader.

Archives hold one gzip member per record (or plain records). The reader takes
records one after another; where a check fails it looks for the next gzip
member or version line that begins a valid record, logs the bytes between as
quarantined, and goes on there.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursewise.session import scratch_path

#: Payloads of fewer bytes are stored each time.
MIN_SHARED = 100
#: Fixed values of the format.
VERSION = b"WARC/1.1\r\n"
GZIP = b"\x1f\x8b\x08"
_VERSION_LINE = re.compile(rb"WARC/1\.[01]\r\n")
_HEADER_END = re.compile(rb"\r\n\r\n")
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
#: An empty gzip member, which closes each line that Spark's text writer puts out.
_EMPTY_MEMBER = bytes([0x1F, 0x8B, 8, 0, 0, 0, 0, 0, 0, 3, 3, 0, 0, 0, 0, 0, 0, 0, 0, 0])
_HEADER, _BLOCK = 1 << 16, 1 << 20


# ---- writing ---------------------------------------------------------------

def record(page_id, uri: str | None, payload: bytes, digest: str, refers_to, length: int) -> bytes:
    """One record, up to and with the blank lines that close it. A revisit has no payload of its own."""
    head = [("WARC-Type", "response" if refers_to is None else "revisit"),
            ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
            ("WARC-Target-URI", re.sub(r"[\r\n]+", " ", uri or "")),
            ("WARC-Payload-Digest", f"sha256:{digest}"),
            ("WARC-Payload-Length", str(length))]
    if refers_to is None:
        block = _HTTP % len(payload) + payload
    else:
        head.append(("WARC-Refers-To", f"<urn:page:{refers_to}>"))
        block = b""
    head += [("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
             ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return VERSION + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes, level: int = 1) -> bytes:
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def with_references(pages: DataFrame, min_shared: int = MIN_SHARED) -> DataFrame:
    """(page_id, url, payload, digest, length, refers_to) of every row.

    Of the rows with equal payloads of ``min_shared`` bytes or more, that with
    the smallest page_id is referred to by the others (by every row without an
    id or with a larger one).
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256)).withColumn("length", F.octet_length("payload").cast("long"))
    shared = (rows.where(F.col("length") >= min_shared).groupBy("digest")
              .agg(F.min("page_id").alias("lowest"), F.count("*").alias("n")).where("n > 1 and lowest is not null")
              .select("digest", "lowest"))
    return rows.join(shared, "digest", "left").select(
        "page_id", "url", "payload", "digest", "length",
        F.when(F.col("page_id").eqNullSafe(F.col("lowest")), None).otherwise(F.col("lowest")).alias("refers_to"))


def write_archives(pages: DataFrame, path: str, compress: bool = True, min_shared: int = MIN_SHARED,
                   records_per_file: int = 2000) -> None:
    """Writes a record for each row of ``pages`` (page_id, url, html) to archives under ``path``.

    The archives are lines of Spark's text writer, whose commit protocol keeps
    the files of lost or repeated tasks out: a line is a gzip member and its
    line end an empty member, or a plain record whose line end is the closing
    blank lines.
    """
    def run(batches):
        for b in batches:
            ids, urls, payloads = b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)
            out, size = [], 0
            for i, (page, url, digest, length, refers) in enumerate(zip(
                    ids, urls, b.column(3).to_pylist(), b.column(4).to_pylist(), b.column(5).to_pylist(), strict=True)):
                r = record(page, url, b"" if refers is not None else payloads[i].as_py(), digest, refers, length)
                out.append(gzip_member(r) if compress else r[:-4])
                size += len(out[-1])
                if size > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["line"])
                    out, size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["line"])

    lines = with_references(pages, min_shared).mapInArrow(run, "line binary").select(F.col("line").cast("string").alias("value"))
    end = _EMPTY_MEMBER if compress else b"\r\n\r\n"
    (lines.write.option("lineSep", end.decode("latin-1")).option("encoding", "ISO-8859-1")
     .option("maxRecordsPerFile", records_per_file).text(path))


# ---- reading ---------------------------------------------------------------

class Damaged(Exception):
    """A check of a record failed."""


def parse(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """(headers, block, end) of the record of ``data`` at ``at``; raises Damaged if any check fails.

    Checks: version line, well-formed headers, Content-Length, closing blank
    lines, and the digests of block and payload where they are given.
    """
    m = _VERSION_LINE.match(data, at)
    if not m:
        raise Damaged("version line")
    stop = data.find(b"\r\n\r\n", m.end())
    if stop < 0:
        raise Damaged("header end")
    head = {}
    for line in data[m.end():stop].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon or not name.strip():
            raise Damaged("header line")
        head[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    if not re.fullmatch(r"[0-9]{1,18}", head.get("content-length", ""), re.ASCII):
        raise Damaged("content length")
    begin, end = stop + 4, stop + 4 + int(head["content-length"])
    if data[end:end + 4] != b"\r\n\r\n":
        raise Damaged("record end")
    block = data[begin:end]
    if not _agrees(head.get("warc-block-digest"), block):
        raise Damaged("block digest")
    if head.get("warc-type") == "response" and not _agrees(head.get("warc-payload-digest"), payload_of(head, block)):
        raise Damaged("payload digest")
    return head, block, end + 4


def _agrees(said: str | None, data: bytes) -> bool:
    kind, _, value = (said or "").partition(":")
    return kind.lower() != "sha256" or value.lower() == hashlib.sha256(data).hexdigest()


def payload_of(head: dict[str, str], block: bytes) -> bytes:
    """The block without the HTTP headers."""
    if head.get("content-type", "").startswith("application/http"):
        return block[block.find(b"\r\n\r\n") + 4:] if b"\r\n\r\n" in block else b""
    return block


class _Inflated:
    """The content of the gzip member at an offset of an archive, inflated as it is read.

    ``end`` is the member's end once it is reached, ``error`` what broke the
    member off; what was inflated before the damage can still be read.
    """

    def __init__(self, read, at: int):
        self._read, self._pos, self._z, self._tail = read, at, zlib.decompressobj(31), b""
        self._held, self._from = bytearray(), 0
        self.end, self.error = None, None

    def _more(self) -> bool:
        if self.end is not None or self.error is not None:
            return False
        got = self._tail
        if not got:
            got = self._read(self._pos, _BLOCK)
            self._pos += len(got)
        if not got:
            self.error = "member cut off"
            return False
        before = self._z.copy()
        try:
            self._held += self._z.decompress(got, _BLOCK)
        except zlib.error:
            self.error = "gzip member"
            try:
                for i in range(len(got)):  # up to the byte that fails
                    self._held += before.decompress(got[i:i + 1])
            except zlib.error:
                pass
            return True
        self._tail = self._z.unconsumed_tail
        if self._z.eof:
            self.end = self._pos - len(self._z.unused_data)
        return True

    def read(self, at: int, n: int) -> bytes:
        while self._from + len(self._held) < at + n and self._more():
            pass
        return bytes(self._held[at - self._from:at - self._from + n])

    def forget(self, before: int) -> None:
        del self._held[:before - self._from]
        self._from = before


def _find(read, at: int, pattern) -> int | None:
    """Where ``pattern`` next matches at or after ``at``, if anywhere. Reads a block at a time."""
    keep = 16
    while got := read(at, _BLOCK + keep):
        if m := pattern.search(got):
            return at + m.start()
        if len(got) <= keep:
            break
        at += len(got) - keep
    return None


_START = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r\n")
_LENGTH = re.compile(rb"\r\ncontent-length:[ \t]*([0-9]{1,18})[ \t]*(?=\r\n)", re.I)
#: Records that are followed from a candidate start on, to see whether they are a payload's.
_CHAIN = 64


def _resume(read, at: int, first: bool) -> int | None:
    """Where to go on after a failed record at ``at``: the next start that isn't part of a payload.

    If the Content-Length of the headers here (without a start among them)
    leads to a start (or the end), all that lies before is its payload; that is only asked of the ``first``
    record of a gap. Else the next candidate counts, unless the records from
    it on end at the closing lines of another record: these are the end of
    the damaged one's payload.
    """
    if first:
        start = read(at, _HEADER)
        stop = start.find(b"\r\n\r\n")
        if stop >= 0 and not _START.search(start, 1, stop) and (m := _LENGTH.search(start[:stop + 2])):
            end = at + stop + 8 + int(m[1])
            if read(end - 4, 4) == b"\r\n\r\n" and (not (after := read(end, 16)) or _START.match(after)):
                return end
    here = _find(read, at + 1, _START)
    while here is not None and (end := _payload_end(read, here)) is not None:
        here = _find(read, end, _START)
    return here


def _payload_end(read, at: int) -> int | None:
    """Where the record ends whose payload ends with the records from ``at`` on; None if they are nobody's payload."""
    for _ in range(_CHAIN):
        try:
            at = _plain(read, at)[2]
        except Damaged:
            return None
        after = read(at, 16)
        if after[:4] == b"\r\n\r\n" and (len(after) == 4 or _START.match(after, 4)):
            return at + 4
    return None


def _inside(content: _Inflated) -> Iterator[tuple]:
    """(headers, block, None) of each record of a member's content, (None, None, reason) of what lies between."""
    at, amid = 0, False
    while content.read(at, 1):
        try:
            head, block, end = _plain(content.read, at)
        except Damaged as e:
            end = _resume(content.read, at, not amid)
            yield None, None, f"{e} at byte {at} of the member's content, to {'its end' if end is None else end}"
            if end is None:
                return
            amid = True
        else:
            amid = False
            yield head, block, None
        at = end
        content.forget(at)


def _digested(head: dict[str, str]) -> bool:
    names = ["warc-block-digest"] + ["warc-payload-digest"] * (head.get("warc-type") == "response")
    return any(head.get(n, "").lower().startswith("sha256:") for n in names)


def salvage(read, size: int) -> Iterator[tuple]:
    """("record", offset, headers, block) and ("gap", offset, length, reason) of an archive, in order.

    ``read(offset, n)`` gives up to n bytes of it; no more than the record at
    hand and one block is held, also of a member with many records (unless its
    records have no digests: those wait for the member's own check). Records
    of a member are taken one by one, also before the place where it breaks
    off; a record lost in a whole member is logged as a gap at the member,
    with its place in the content as the reason. A candidate start counts only
    when the record there passes every check. Whole records in the payload of
    a damaged plain record aren't taken for the archive's where that record's
    length or its closing lines show them to be payload; a whole member that
    lies uncompressed in a damaged member can't be told from one of the archive.
    """
    at, gap, reason = 0, -1, ""
    while at < size:
        records, lost, why, end = [], [], None, None
        if read(at, 3) == GZIP:
            member = _Inflated(read, at)
            for head, block, damage in _inside(member):
                if damage:
                    lost.append(damage)
                elif records or not _digested(head):
                    records.append((head, block))
                else:
                    if gap >= 0:
                        yield "gap", gap, at - gap, reason
                        gap = -1
                    yield "record", at, head, block
            if member.error:
                records, why = [], member.error
            end = member.end
        else:
            try:
                head, block, end = _plain(read, at)
                records = [(head, block)]
            except Damaged as e:
                why = str(e)
        if why:
            goes_on = _resume(read, at, gap < 0)
            if gap < 0:
                gap, reason = at, why
            at = size if goes_on is None else goes_on
            continue
        if records and gap >= 0:  # an empty member proves nothing amid damage
            yield "gap", gap, at - gap, reason
            gap = -1
        for head, block in records:
            yield "record", at, head, block
        if gap < 0:
            for damage in lost:
                yield "gap", at, end - at, damage
        at = end
    if gap >= 0:
        yield "gap", gap, size - gap, reason


def _plain(read, at: int) -> tuple[dict[str, str], bytes, int]:
    """(headers, block, end) of the uncompressed record at ``at``, read only as far as its headers say."""
    start = read(at, _HEADER)
    if not _VERSION_LINE.match(start):
        raise Damaged("version line")
    stop = start.find(b"\r\n\r\n")
    if stop < 0:  # a very long header
        stop = _find(read, at, _HEADER_END)
        if stop is None:
            raise Damaged("header end")
        stop -= at
        start = read(at, stop + 4)
    m = _LENGTH.search(start[:stop + 2])
    if not m:
        raise Damaged("content length")
    end = stop + 4 + int(m[1])
    if read(at + end, 4) != b"\r\n\r\n":
        raise Damaged("record end")
    head, block, end = parse(start[:end + 4] if end + 4 <= len(start) else read(at, end + 4))
    return head, block, at + end


RECORDS = ("kind string, archive string, offset long, length long, reason string, record_type string, page_id long, "
           "refers_to long, uri string, payload binary, payload_bytes long, payload_digest string")


def _opened(uri: str):
    """(read, size, file) of an archive in any file system that pyarrow or the URI's scheme knows."""
    system, path = fs.FileSystem.from_uri(uri if not re.match(r"file:/[^/]", uri) else "file://" + uri[5:])
    file = system.open_input_file(path)
    return (lambda at, n: file.read_at(min(n, max(0, file.size() - at)), at)), file.size(), file


def _page(value: str | None) -> int | None:
    m = re.fullmatch(r"<urn:page:(-?[0-9]+)>", value or "")
    return int(m[1]) if m else None


def read_archives(spark, path: str, payloads: bool = True) -> DataFrame:
    """Records and quarantined gaps of all archives under ``path``: RECORDS.

    Rows of kind ``record`` have their type, ids, payload and its digest as
    computed from the bytes read (of a revisit: as its headers say, as the
    payload is elsewhere). Rows of kind ``gap`` have offset, length and reason.
    An archive is read by one task as a stream; archives are bounded by
    whoever writes them. ``payloads=False`` leaves the payload column null.
    """
    names = [c.split()[0] for c in RECORDS.split(", ")]
    kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(),
             pa.string(), pa.binary(), pa.int64(), pa.string()]

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    def run(batches):
        for b in batches:
            for uri in b.column(0).to_pylist():
                read, size, file = _opened(uri)
                rows, held = [], 0
                with file:
                    for kind, offset, *rest in salvage(read, size):
                        if kind == "gap":
                            rows.append(("gap", uri, offset, rest[0], rest[1], *[None] * 7))
                        else:
                            head, block = rest
                            kind_of, refers = head.get("warc-type"), _page(head.get("warc-refers-to"))
                            if kind_of == "revisit":
                                payload, n = None, head.get("warc-payload-length", "")
                                n = int(n) if n.isdecimal() else None
                                digest = head.get("warc-payload-digest", "").partition(":")[2] or None
                            else:
                                payload = payload_of(head, block)
                                n, digest = len(payload), hashlib.sha256(payload).hexdigest()
                            rows.append(("record", uri, offset, None, None, kind_of, _page(head.get("warc-record-id")), refers,
                                         head.get("warc-target-uri"), payload if payloads else None, n, digest))
                            held += len(payload or b"") if payloads else 300
                        if held > 8 << 20 or len(rows) > 10_000:
                            yield batch(rows)
                            rows, held = [], 0
                if rows:
                    yield batch(rows)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path")
    return files.repartition(max(1, files.count()), "path").mapInArrow(run, RECORDS)


def op1_warc_salvage(spark, sf_dir: str) -> DataFrame:
    """The pages written to archives and read back by the salvage reader.

    A null html is an empty payload; a row without page_id comes back without.
    Archives just written have no gaps: one fails the query, so no page is lost unnoticed.
    """
    path = scratch_path(spark, "llm-warc")
    write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    out = read_archives(spark, path, payloads=False)
    whole = F.assert_true(F.col("kind") == "record", F.concat_ws(" ", "archive", "offset", "reason"))
    out = out.where(F.coalesce(whole.cast("boolean"), F.lit(True)))
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
