"""WARC archives: written one gzip member to a record, read back in sequence.

Writing: equal payloads (by SHA-256 and length) become one ``response`` record,
that of the smallest page id, and ``revisit`` records that name it and hold no
payload.  Tasks write archives of ``ARCHIVE_BYTES`` under the shared folder, each
under a name of its own; what counts is the list of archives that Spark commits,
so files of lost or repeated tasks are never read.  A payload that a third of
all pages share is no hot group: pages are dealt by payload and ``SALTS``.

Reading: an archive is a stream of gzip members.  A task inflates one piece by
piece (``PIECE`` bytes of either side in memory), reads the named fields up to
the blank line, then as many bytes as Content-Length says, and checks the
digests of block and payload, the end of the record and that of the member.
A payload is held in memory only where it is asked for.

Archives are opened with ``pyarrow.fs``: local and mounted paths, HDFS, S3, GCS.

Results for odd rows: a null html is an empty payload; a null url gives a record
without target (white space and control characters are percent-encoded); a null
page id counts as the greatest.  Of rows with equal ids and payloads one is the
response, the others revisit it; equal ids with different payloads are pages of
their own.  An empty table gives no archives and no records.  Payloads of any
length are handled whole.  Input columns other than the three are not read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skein.llm.common import ship, stored
from skein.session import fresh_path

#: An archive is closed once it has this many bytes.
ARCHIVE_BYTES = 64 << 20

#: Keys over which the copies of one payload are dealt.
SALTS = 256

#: Bytes that are read, or inflated, at once; most bytes of a record's named fields.
PIECE = 256 << 10
MOST_FIELDS = 1 << 20

#: Fixed values of the format.
VERSION = b"WARC/1.1"
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n\r\n"
GZIP = b"\x1f\x8b\x08"

ARCHIVES = "path string, bytes long, records long"
RECORDS = (
    "path string, offset long, record_type string, record_id string, target_uri string, refers_to string, "
    "payload_bytes long, payload_digest string, payload binary, problem string"
)
_ARCHIVES = pa.schema([("path", pa.string()), ("bytes", pa.int64()), ("records", pa.int64())])
_RECORDS = pa.schema(
    [("path", pa.string()), ("offset", pa.int64())]
    + [(c, pa.string()) for c in ("record_type", "record_id", "target_uri", "refers_to")]
    + [("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()), ("problem", pa.string())]
)


class Broken(ValueError):
    """A record that is not as the format, or its own fields, say."""


def _digest(h) -> str:
    return base64.b32encode(h.digest()).decode()


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:/") and not path.startswith("file:///"):
        path = path[len("file:") :]
    return fs.FileSystem.from_uri(path)


# ------------------------------------------------------------------ writing
def record(kind: str, record_id: str, block: bytes, fields: dict[str, str | None]) -> bytes:
    """One record as a gzip member."""
    named = {"WARC-Type": kind, "WARC-Record-ID": f"<{record_id}>", "WARC-Date": DATE}
    named |= {k: v for k, v in fields.items() if v is not None}
    named |= {"WARC-Block-Digest": "sha1:" + _digest(hashlib.sha1(block)), "Content-Length": str(len(block))}
    head = VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in named.items()).encode() + b"\r\n"
    z = zlib.compressobj(wbits=31)
    return b"".join([z.compress(head), z.compress(block), z.compress(END), z.flush()])


def _uri(url: str | None) -> str | None:
    return None if url is None else "".join(f"%{ord(c):02X}" if c <= " " or c == "\x7f" else c for c in url)


def page_record(record_id: str, url: str | None, payload: bytes, refers_to: str | None) -> bytes:
    """The page's response, or with ``refers_to`` its revisit: as that, but without the payload."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    fields = {
        "WARC-Target-URI": _uri(url),
        "Content-Type": "application/http; msgtype=response",
        "WARC-Payload-Digest": "sha1:" + _digest(hashlib.sha1(payload)),
    }
    if refers_to is None:
        return record("response", record_id, head + payload, fields)
    return record("revisit", record_id, head, fields | {"WARC-Profile": PROFILE, "WARC-Refers-To": f"<{refers_to}>"})


def _write(folder: str, archive_bytes: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, base = _opened(folder)
        out, name, size, count = None, "", 0, 0

        def closed() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"]), pa.array([size]), pa.array([count])], schema=_ARCHIVES)

        for batch in batches:
            columns = [batch.column(c) for c in ("record_id", "url", "payload", "refers_to")]
            for i in range(batch.num_rows):
                if out is None:
                    where.create_dir(base, recursive=True)
                    name, count = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = where.open_output_stream(f"{base}/{name}", compression=None)
                    info = record("warcinfo", f"urn:x-archive:{name}", b"format: WARC File Format 1.1\r\n", {"Content-Type": "application/warc-fields"})
                    size = out.write(info)
                record_id, url, payload, refers_to = (c[i].as_py() for c in columns)
                size += out.write(page_record(record_id, url, payload, refers_to))
                count += 1
                if size >= archive_bytes:
                    yield closed()
                    out = None
        if out is not None:
            yield closed()

    return work


def planned(pages: DataFrame, place: Column | None = None, min_bytes: int = 0) -> DataFrame:
    """Of each page its record: ``record_id``, ``url``, ``payload``, and ``refers_to``, the record that it revisits.

    ``place``: text that tells the rows apart, the same whenever the table is
    read; without it the table is stored first.
    """
    if place is None:
        pages = stored(pages.select("page_id", "url", "html", F.monotonically_increasing_id().cast("string").alias("_place")), "pages")
        place = F.col("_place")
    rows = pages.select(
        F.col("page_id").cast("long").alias("id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload"), place.alias("place"),
    )
    key = ["sha", "n_bytes", "salt"]
    rows = rows.withColumns(
        {"sha": F.unhex(F.sha2("payload", 256)), "n_bytes": F.octet_length("payload"), "salt": F.pmod(F.xxhash64("place"), F.lit(SALTS)).cast("short")}
    )
    own = F.concat(F.lit("urn:x-page:"), F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(":"), F.col("place"))
    # The smallest id first, null last; of rows that agree in it, the smallest record id.
    first = F.struct(F.col("id").isNull().alias("none"), "id", own.alias("record"))
    some = rows.where(F.col("n_bytes") >= min_bytes).groupBy(*key).agg(F.min(first).alias("first"), F.count("*").alias("n"))
    all_salts = Window.partitionBy("sha", "n_bytes")
    some = some.select(*key, F.min("first").over(all_salts)["record"].alias("response"), F.sum("n").over(all_salts).alias("n"))
    copied = some.where("n > 1").drop("n")
    joined = rows.withColumn("record_id", own).join(copied, key, "left")
    return joined.select("record_id", "url", "payload", F.when(F.col("response") != F.col("record_id"), F.col("response")).alias("refers_to"))


def write(pages: DataFrame, place: Column | None = None, min_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as archives; returns their list: path, bytes, page records.

    Equal payloads of ``min_bytes`` or more are written once.
    """
    ship(pages.sparkSession)
    folder = fresh_path(pages.sparkSession, "llm", "warc")
    return stored(planned(pages, place, min_bytes).mapInArrow(_write(folder, archive_bytes), ARCHIVES), "archives")


# ------------------------------------------------------------------ reading
class _Source:
    """Compressed bytes of an archive, in pieces, with what was read too far put back."""

    def __init__(self, stream):
        self.stream, self.rest, self.at = stream, b"", 0

    def piece(self) -> bytes:
        raw, self.rest = self.rest or self.stream.read(PIECE), b""
        self.at += len(raw)
        return raw

    def back(self, raw: bytes) -> None:
        self.rest = raw + self.rest
        self.at -= len(raw)

    def skip(self) -> None:
        """To the next place that looks like the begin of a member."""
        tail = b""
        while raw := self.piece():
            if (k := (tail + raw).find(GZIP)) >= 0:
                self.back((tail + raw)[k:])
                return
            tail = raw[-2:]


class _Member:
    """One gzip member's plain bytes, inflated as they are asked for."""

    def __init__(self, source: _Source):
        self.source, self.inflate, self.plain, self.last = source, zlib.decompressobj(wbits=31), b"", b""

    def _more(self) -> bool:
        if self.inflate.eof:
            return False
        self.last = self.inflate.unconsumed_tail or self.source.piece()
        if not self.last:
            raise Broken("the archive ends within a record")
        self.plain += self.inflate.decompress(self.last, PIECE)
        if self.inflate.eof:
            self.source.back(self.inflate.unused_data)
        return True

    def until(self, mark: bytes, most: int) -> bytes:
        """The bytes up to the mark, which is passed over."""
        while (k := self.plain.find(mark)) < 0:
            if len(self.plain) > most or not self._more():
                raise Broken("fields without an end")
        found, self.plain = self.plain[:k], self.plain[k + len(mark) :]
        return found

    def take(self, n: int) -> Iterator[bytes]:
        """The next n bytes, in pieces."""
        while n:
            if not self.plain and not self._more():
                raise Broken("the block is shorter than Content-Length")
            piece, self.plain = self.plain[:n], self.plain[n:]
            n -= len(piece)
            if piece:
                yield piece

    def finish(self) -> None:
        """The record's end, and nothing after it."""
        while self._more():
            if len(self.plain) > len(END):
                break
        if self.plain != END:
            raise Broken("the record does not end after its block")

    def drop(self, at: int) -> None:
        """Pass over what is left of a member that begins at ``at``; where it can't be inflated, go to the next begin."""
        try:
            while self._more():
                self.plain = b""
        except (Broken, zlib.error):
            # Of the piece in hand, which may hold the next members, only this one's first byte is passed over.
            begin = self.source.at - len(self.last)
            self.source.back(self.last[max(0, at + 1 - begin) :])
            self.source.skip()


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    if lines[0] != VERSION.decode() and lines[0] != "WARC/1.0":
        raise Broken("not a record of a known version")
    named: dict[str, str] = {}
    last = None
    for line in lines[1:]:
        if line[:1] in (" ", "\t") and last:  # a folded line goes on with the field before
            named[last] += " " + line.strip()
            continue
        last, colon, value = line.partition(":")
        last = last.strip().lower()
        if not colon or not last:
            raise Broken("a field without a name")
        named[last] = value.strip()
    return named


def _checked(declared: str | None, h, what: str) -> None:
    if declared is None:
        return
    how, _, value = declared.partition(":")
    if how.lower() == "sha1" and value.upper().rstrip("=") not in (_digest(h), h.hexdigest().upper()):
        raise Broken(f"the {what} digest differs")


def _number(text: str | None) -> int:
    if text is None or not (text.isascii() and text.isdigit()):
        raise Broken("no Content-Length")
    return int(text)


def _read_record(member: _Member, payloads: bool) -> dict:
    named = _fields(member.until(END, MOST_FIELDS))
    size, http = _number(named.get("content-length")), named.get("content-type", "").lower().startswith("application/http")
    block, payload, head, n, kept = hashlib.sha1(), hashlib.sha1(), b"", 0, bytearray()
    inside = not http  # whether the bytes are the payload's yet
    for piece in member.take(size):
        block.update(piece)
        if not inside:
            # The mark may lie across two pieces.
            head += piece
            if (k := head.find(END)) < 0:
                if len(head) > MOST_FIELDS:
                    raise Broken("HTTP fields without an end")
                continue
            head, piece, inside = head[:k], head[k + len(END) :], True
        payload.update(piece)
        n += len(piece)
        if payloads:
            kept += piece
    member.finish()
    _checked(named.get("warc-block-digest"), block, "block")
    kind, declared = named.get("warc-type"), named.get("warc-payload-digest")
    if http and not inside:
        raise Broken("HTTP fields without an end")
    said = next((v.strip() for k, _, v in (x.partition(":") for x in head.decode("latin-1").split("\r\n")) if k.strip().lower() == "content-length"), None) if http else None
    if kind == "revisit":
        # The payload is elsewhere: its digest and length are told by the fields.
        n, digest, kept = int(said) if said and said.isdigit() else None, declared.partition(":")[2] if declared else None, None
    else:
        _checked(declared, payload, "payload")
        if said is not None and _number(said) != n:
            raise Broken("the payload's length differs")
        digest = _digest(payload)
    return {
        "record_type": kind, "record_id": named.get("warc-record-id", "").strip("<>") or None, "target_uri": named.get("warc-target-uri"),
        "refers_to": named.get("warc-refers-to", "").strip("<>") or None, "payload_bytes": n, "payload_digest": digest,
        "payload": bytes(kept) if payloads and kept is not None else None, "problem": None,
    }


def records(stream, payloads: bool = False, strict: bool = True) -> Iterator[dict]:
    """All records of one archive in their order, with the place of each one's member.

    With ``strict`` a broken record raises :class:`Broken`; otherwise it gives
    a row with its ``problem`` alone, and reading goes on at the next member.
    """
    source = _Source(stream)
    while True:
        raw = source.piece()
        if not raw:
            return
        source.back(raw)
        at, member = source.at, _Member(source)
        try:
            yield {"offset": at, **_read_record(member, payloads)}
            continue
        except (Broken, zlib.error) as e:
            if strict:
                raise Broken(f"byte {at}: {e}") from e
            problem = str(e)
        yield {"offset": at, "problem": problem}
        member.drop(at)


def _read(payloads: bool, strict: bool):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                where, name = _opened(path)
                rows, held = [], 0
                with where.open_input_stream(name, compression=None) as stream:
                    for row in records(stream, payloads, strict):
                        rows.append({"path": path, **row})
                        held += 200 + len(row.get("payload") or b"")
                        if held >= 16 * PIECE:
                            yield pa.RecordBatch.from_pylist(rows, schema=_RECORDS)
                            rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema=_RECORDS)

    return work


def read(archives: DataFrame, payloads: bool = False, strict: bool = True) -> DataFrame:
    """Every record of the archives named by ``path``, warcinfo included; ``problem`` is null for sound ones."""
    ship(archives.sparkSession)
    paths = archives.select("path")
    # An archive is a task's work: without this, the short list would be one task's.
    return paths.repartition(max(1, paths.count())).mapInArrow(_read(payloads, strict), RECORDS)


def listed(spark: SparkSession, path: str) -> DataFrame:
    """The archives in a folder or under a pattern (names only, nothing is read)."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").option("recursiveFileLookup", "true").load(path).select("path", F.col("length").alias("bytes"))


def report(pages: DataFrame, place: Column | None = None) -> DataFrame:
    """Write the pages and read the archives back: a row per page, as its record tells it."""
    found = read(write(pages, place)).where(F.col("record_type").isin("response", "revisit"))
    page = lambda c: F.expr(f"try_cast(split_part({c}, ':', 3) AS bigint)")
    return found.select(
        page("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        page("refers_to").alias("refers_to"),
    )


SQL = """WITH p AS (SELECT row_number() OVER () AS r, page_id, coalesce(html, '') AS html FROM pages),
q AS (SELECT *, first_value(r) OVER w AS first_row, first_value(page_id) OVER w AS first_id FROM p
      WINDOW w AS (PARTITION BY html ORDER BY page_id NULLS LAST, r))
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + ((('0x' || substr(sha1(html), 1 + 10 * (i // 8), 10))::BIGINT >> CAST(35 - 5 * (i % 8) AS INTEGER)) & 31) AS BIGINT), 1)
                        FOR i IN range(32)], '') AS payload_digest,
       CASE WHEN r = first_row THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN r <> first_row THEN first_id END AS refers_to
FROM q"""
