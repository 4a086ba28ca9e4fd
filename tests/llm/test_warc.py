"""WARC archives: round trips, an independent parser, broken archives, and the contract's rows."""

import base64
import gzip
import hashlib
import io
import os
import sys

import pytest
from llm_rows import SF001

from skein.llm import warc as W


def sha(b):
    return base64.b32encode(hashlib.sha1(b).digest()).decode()


def brute(rows):
    """The contract's rows of (page_id, url, html)."""
    key = lambda r: (r[0] is None, r[0] or 0)
    first, out = {}, []
    for i, _, html in sorted(rows, key=key):
        body = (html or "").encode()
        out.append((i, len(body), sha(body), "revisit" if body in first else "response", first.get(body)))
        first.setdefault(body, i)
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r)[:5] for r in df.collect()), key=str)


ROWS = [
    (7, "http://a/7", "<p>one</p>"),
    (3, "http://a/3", "<p>one</p>"),
    (3, "http://a/3", "<p>one</p>"),
    (3, "http://a/3", "<p>other</p>"),
    (None, "http://a/n", "<p>one</p>"),
    (None, None, "<p>lonely</p>"),
    (None, None, "<p>lonely</p>"),
    (1, None, None),
    (2, "http://a/\r\nWARC-Type: fake é", ""),
    (4, "", " \r\n\r\n \x00 \U0001d11e WARC/1.1\r\n\r\n"),
    (5, "http://a/5", "long text " * 400_000),
    (6, "http://a/6", "\x1f\x8b\x08" * 1000),
    (-9, "http://a/9", "<p>one</p>"),
] + [(i, f"http://b/{i}", "<p>shared by many</p>") for i in range(100, 400)]


def pages(spark, rows=ROWS):
    named = [(*r, "x", 1, None) for r in rows]
    return spark.createDataFrame(named, "page_id long, url string, html string, record_type string, payload int, place string").repartition(5)


def test_odd_rows_against_brute_force(spark):
    assert result(W.report(pages(spark))) == brute(ROWS)


def test_payloads_come_back(spark):
    df = W.read(W.write(pages(spark), archive_bytes=2000), payloads=True).where("record_type <> 'warcinfo'")
    got = {(r.record_id, r.record_type): r for r in df.collect()}
    assert len(got) == len(ROWS)
    bodies = {k[0]: bytes(r.payload) for k, r in got.items() if k[1] == "response"}
    assert sorted(bodies.values()) == sorted({(r[2] or "").encode() for r in ROWS})
    for (_, kind), r in got.items():
        body = bodies[r.refers_to] if kind == "revisit" else bytes(r.payload)
        assert (r.payload_bytes, r.payload_digest, r.problem) == (len(body), sha(body), None)
        assert (r.payload is None) == (kind == "revisit")
    assert any(r.target_uri == "http://a/%0D%0AWARC-Type:%20fake%20é" for r in got.values())


def plain_records(path):
    """An archive's records, by the standard library's gzip reader and slices."""
    data, out = gzip.open(path).read(), []
    while data:
        head, _, rest = data.partition(b"\r\n\r\n")
        fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        n = int(fields["Content-Length"])
        assert rest[n : n + 4] == b"\r\n\r\n" and fields["WARC-Block-Digest"] == "sha1:" + sha(rest[:n])
        out.append((fields, rest[:n]))
        data = rest[n + 4 :]
    return out


def test_archives_as_another_parser_reads_them(spark):
    archives = W.write(pages(spark), archive_bytes=4000).collect()
    assert len(archives) > 5 and sum(a.records for a in archives) == len(ROWS)
    types = {}
    for a in archives:
        assert os.path.getsize(a.path) == a.bytes
        found = plain_records(a.path)
        assert found[0][0]["WARC-Type"] == "warcinfo" and len(found) == a.records + 1
        for fields, block in found[1:]:
            types[fields["WARC-Type"]] = types.get(fields["WARC-Type"], 0) + 1
            body = block.partition(b"\r\n\r\n")[2]
            assert (body == b"") if fields["WARC-Type"] == "revisit" else fields["WARC-Payload-Digest"] == "sha1:" + sha(body)
    assert types == {"response": sum(r[3] == "response" for r in brute(ROWS)), "revisit": sum(r[3] == "revisit" for r in brute(ROWS))}


def test_small_payloads_are_all_responses(spark):
    rows = [r for r in W.read(W.write(pages(spark), min_bytes=12)).collect() if r.record_type == "revisit"]
    assert {r.payload_bytes for r in rows} == {len("<p>shared by many</p>"), len("<p>lonely</p>")}


class Slow(io.BytesIO):
    """A stream that gives a few bytes at a time."""

    def read(self, n=-1):
        return super().read(min(n, 7))


def archive(n=4):
    return [W.page_record(f"urn:x-page:{i}:0", f"http://a/{i}", bytes([65 + i]) * (100 + 40 * i), None) for i in range(n)]


@pytest.mark.parametrize("stream", [io.BytesIO, Slow])
def test_sequence_and_places(stream):
    parts = archive()
    rows = list(W.records(stream(b"".join(parts)), payloads=True))
    assert [r["offset"] for r in rows] == [sum(map(len, parts[:i])) for i in range(4)]
    assert [r["payload"] for r in rows] == [bytes([65 + i]) * (100 + 40 * i) for i in range(4)]
    assert list(W.records(stream(b""))) == []


def broken(kind):
    parts = archive()
    plain = gzip.decompress(parts[1])
    if kind == "bytes":
        parts[1] = parts[1][:60] + bytes(b ^ 0x55 for b in parts[1][60:70]) + parts[1][70:]
    elif kind == "digest":
        parts[1] = gzip.compress(plain.replace(b"BBBB", b"BBCB", 1))
    elif kind == "payload digest":
        own = W._digest(hashlib.sha1(b"B" * 140))
        parts[1] = gzip.compress(plain.replace(own.encode(), b"A" * 32))
    elif kind == "short":
        parts[1] = gzip.compress(plain[:-20])
    elif kind == "long":
        parts[1] = gzip.compress(plain + b"more")
    elif kind == "version":
        parts[1] = gzip.compress(plain.replace(b"WARC/1.1", b"WARC/9.9"))
    elif kind == "length":
        parts[1] = gzip.compress(plain.replace(b"Content-Length: ", b"Content-Length: -"))
    elif kind == "no length":
        parts[1] = gzip.compress(plain.replace(b"\r\nContent-Length: 2", b"\r\nX-Length: 2"))
    return parts


@pytest.mark.parametrize("stream", [io.BytesIO, Slow])
@pytest.mark.parametrize("kind", ["bytes", "digest", "payload digest", "short", "long", "version", "length", "no length"])
def test_broken_records(kind, stream):
    data = b"".join(broken(kind))
    with pytest.raises(W.Broken):
        list(W.records(stream(data)))
    rows = list(W.records(stream(data), payloads=True, strict=False))
    sound = [r["payload"] for r in rows if not r["problem"]]
    assert sound == [bytes([65 + i]) * (100 + 40 * i) for i in (0, 2, 3)]
    assert [r["offset"] for r in rows if r["problem"]][0] == len(archive()[0])


def test_cut_archive():
    data = b"".join(archive())[:-30]
    with pytest.raises(W.Broken):
        list(W.records(io.BytesIO(data)))
    rows = list(W.records(io.BytesIO(data), strict=False))
    assert len(rows) == 4 and [bool(r["problem"]) for r in rows] == [False, False, False, True]


def test_empty_table_and_listing(spark):
    none = pages(spark).limit(0)
    assert W.report(none).count() == 0
    archives = W.write(pages(spark))
    folder = os.path.dirname(archives.first().path)
    assert W.read(W.listed(spark, folder)).where("record_type <> 'warcinfo'").count() == len(ROWS)


def test_table_against_brute_force(spark):
    df = spark.read.parquet(f"{SF001}/pages.parquet")
    want = brute([(r.page_id, r.url, r.html) for r in df.collect()])
    assert result(W.report(df)) == want


def test_sql_twin(spark):
    sys.path.insert(0, "tools")
    import duckdb

    con = duckdb.connect()
    rows = [(r[0], r[2]) for r in ROWS if r[0] is not None]
    con.execute("CREATE TABLE pages(page_id BIGINT, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?)", rows)
    got = sorted((tuple(r) for r in con.execute(W.SQL).fetchall()), key=str)
    assert got == brute([(i, None, h) for i, h in rows])
