"""Archives: format, equal payloads, verification, damage."""

import base64
import gzip
import hashlib
import zlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from quarry.llm.lookup import looked_up
from quarry.llm.warc import archive_round_trip, broken_revisits, read_archives, record, write_archives

PAGE = "page_id long, url string, html string"
ODD = [(1, "http://a/1", "same"), (2, None, "same"), (3, "", "same"), (3, "", "same"), (1, "http://a/1", "same"),
       (None, "x y\r\nWARC-Type: bad", "same"), (7, "q", None), (8, "q", ""), (None, "q", "lone"), (None, "q", "lone"),
       (9, "http://é/ü", "é日😀\r\n\r\n" * 50_000), (10, "u", "HTTP/1.1 200 OK\r\nContent-Length: 3\r\n\r\nabc"),
       (11, "u", "\r\n\r\n"), (12, "u", "WARC/1.1\r\n")]


def b32(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def plain(rows, min_bytes=0):
    ids = {}
    for i, _, h in rows:
        ids.setdefault(h or "", []).append(i)
    out = []
    for i, _, h in rows:
        h = h or ""
        known = [x for x in ids[h] if x is not None]
        first = min(known) if known and len(h.encode()) >= min_bytes and len(ids[h]) > 1 else None
        revisit = first is not None and first != i
        out.append((i, len(h.encode()), b32(h.encode()), "revisit" if revisit else "response",
                    first if revisit else None))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("min_bytes", [0, 5])
def test_round_trip(ckpt, min_bytes):
    crowd = [(100 + i, "u", "hot" if i % 3 else f"page {i}") for i in range(600)]
    df = ckpt.createDataFrame(ODD + crowd, PAGE).repartition(5)
    for extra in ("first", "_sha", "_n", "_salt", "archive", "problem"):
        df = df.withColumn(extra, F.lit("x"))
    assert rows_of(archive_round_trip(df, min_bytes)) == plain(ODD + crowd, min_bytes)


def test_empty_table(ckpt):
    assert archive_round_trip(ckpt.createDataFrame([], PAGE)).collect() == []


def test_files_and_payloads(ckpt, tmp_path):
    """Members of one record each, small files, payloads as they were."""
    df = ckpt.createDataFrame(ODD, PAGE).coalesce(1)
    made = write_archives(df, str(tmp_path / "out"), archive_bytes=300)
    names = [r.archive for r in made.collect()]
    assert len(names) > 3 and all(Path(n).exists() for n in names)
    for n in names:
        raw, members = Path(n).read_bytes(), 0
        while raw:
            d = zlib.decompressobj(31)
            assert d.decompress(raw).startswith(b"WARC/1.1\r\n")
            raw, members = d.unused_data, members + 1
        assert members == next(r.records for r in made.collect() if r.archive == n)
    got = read_archives(made, with_payload=True).collect()
    assert not [r for r in got if r.problem]
    assert {bytes(r.payload) for r in got if r.record_type == "response"} == {(h or "").encode() for _, _, h in ODD}
    assert {r.target for r in got if r.record_id == "<urn:x-page:none>"} >= {"q"}
    assert all("\r" not in (r.target or "") for r in got)


def _archive(path, members):
    path.write_bytes(b"".join(members))
    return str(path)


def _gz(parts):
    return gzip.compress(b"".join(parts))


def test_damage_is_reported_and_passed_over(ckpt, tmp_path):
    date = "2024-01-01T00:00:00Z"
    good = [record(i, "u", b"payload %d" % i, None, date) for i in range(6)]
    flipped = bytearray(_gz(good[1]))
    flipped[len(flipped) // 2] ^= 0xFF
    short = [good[2][0], good[2][1], good[2][2][:-1], good[2][3]]
    other = [good[3][0].replace(b"WARC-Block-Digest: sha1:", b"WARC-Block-Digest: sha1:A"), *good[3][1:]]
    payload = [good[4][0].replace(b"WARC-Payload-Digest: sha1:", b"WARC-Payload-Digest: sha1:A"), *good[4][1:]]
    name = _archive(tmp_path / "a.warc.gz", [_gz(good[0]), bytes(flipped), _gz(short), _gz(other), _gz(payload),
                                             gzip.compress(b"no record"), _gz(good[5]), _gz(good[1])[:-9]])
    empty = _archive(tmp_path / "empty.warc.gz", [])
    rows = read_archives(ckpt.createDataFrame([(name,), (None,), (empty,)], "archive string")).collect()
    rows.sort(key=lambda r: r.offset)
    assert [r.problem is None for r in rows] == [True, False, False, False, False, False, True, False]
    assert [r.problem for r in rows][2:5] == ["the block is not as long as Content-Length says",
                                              "the block's digest differs", "the payload's digest differs"]
    assert rows[7].problem == "the member is cut off"


def test_broken_revisits(ckpt, tmp_path):
    date = "2024-01-01T00:00:00Z"
    parts = [record(1, "u", b"x", None, date), record(2, "u", b"x", 1, date), record(3, "u", b"y", 1, date),
             record(4, "u", b"x", 9, date)]
    name = _archive(tmp_path / "r.warc.gz", [_gz(p) for p in parts])
    read = read_archives(ckpt.createDataFrame([(name,)], "archive string"))
    assert sorted((r.refers_to, r.n) for r in broken_revisits(read).collect()) == [
        ("<urn:x-page:1>", 1), ("<urn:x-page:9>", 1)]


def test_lookup_with_hot_keys(ckpt):
    rows = ckpt.range(3000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN -1 ELSE id % 500 END AS k", "1 AS one")
    answers = rows.groupBy("k").count().where("k % 2 <> 0").selectExpr("k", "k * 10 AS v", "count AS w")
    got = looked_up(rows, answers, ["k"], "w", 3000, share=10)
    want = {r.id: (r.k * 10 if r.k % 2 else None) for r in rows.collect()}
    assert got.columns == ["id", "k", "one", "v"] and got.count() == 3000
    assert {r.id: r.v for r in got.collect()} == want
