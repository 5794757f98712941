import hashlib
import io
import random
import zlib

from regionflow.llm import warc
from regionflow.llm.common import shared_path


def test_any_split_finds_every_record_once():
    rng = random.Random(12)
    records = []
    for i in range(40):
        # Stored, not compressed, so that the payload's own magic and headers stand in the file.
        body = b"".join(rng.choice([warc.MAGIC, b"WARC/1.1", b"x" * rng.randrange(50), zlib.compress(b"y" * 99)]) for _ in range(rng.randrange(9)))
        records.append(warc.record(str(i), "u", body, 1))
    raw = b""
    for r in records:
        d = zlib.compressobj(rng.choice([0, 6]), zlib.DEFLATED, 31)
        raw += d.compress(r) + d.flush()
    for split in (1, 7, 64, 1000, 1 << 20):
        got = [x for s in range(0, len(raw), split) for x in warc.members(io.BytesIO(raw), len(raw), s, min(s + split, len(raw)))]
        assert got == [(r, True) for r in records]


def test_round_trip(spark):
    rows = [(5, "http://a", "<p>same</p>"), (3, None, "<p>same</p>"), (9, "http://b\r\nX: y", None), (9, "http://c", ""), (7, "u", "é" * 400_000), (None, "n", "<p>same</p>"), (None, "n", "alone"), (4, "r", "twice"), (4, "r", "twice"), (4, "q", "twice"), (8, None, "twice"), (8, None, "twice")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as n", "'x' as sha")
    manifest = warc.write_archives(df, shared_path(spark, "test"))
    got = warc.read_archives(manifest, split=100).collect()
    assert len(got) == len(rows)
    want = []
    for i, u, h in rows:
        want.append((i, warc.digest((h or "").encode()), len((h or "").encode())))
    key = lambda x: tuple((v is None, v) for v in x)
    assert sorted(((r.page_id and int(r.page_id), r.payload_digest, r.payload_bytes) for r in got), key=key) == sorted(want, key=key)
    by = {}
    for r in got:
        by.setdefault(r.payload_digest, []).append(r)
    for same in by.values():
        (first,) = [r for r in same if r.record_type == "response"]
        ids = [int(r.page_id) for r in same if r.page_id]
        assert first.page_id == (str(min(ids)) if ids else None)
        assert all(r.refers_to == first.page_id for r in same if r is not first and r.record_type == "revisit") and first.refers_to is None
    assert {r.html for r in got if r.html is not None} == {h or "" for _, _, h in rows}
    least = warc.read_archives(warc.write_archives(df, shared_path(spark, "test"), least=6)).collect()
    assert sum(r.record_type == "revisit" for r in least) == 2
    assert warc.read_archives(warc.write_archives(df.limit(0), shared_path(spark, "test"))).count() == 0
    assert warc.archive_files(spark, manifest.first().path.rsplit("/", 1)[0]).count() == manifest.count()


def test_broken_archives_are_reported(spark, tmp_path):
    def member(raw, level=6):
        d = zlib.compressobj(level, zlib.DEFLATED, 31)
        return d.compress(raw) + d.flush()

    good = [warc.record(str(i), "u", f"payload {i}".encode(), 1) for i in range(4)]
    damaged = bytearray(member(warc.record("9", "u", random.Random(1).randbytes(3000), 1), 0))
    damaged[-6] ^= 0xFF  # the member's own checksum
    other = good[1].replace(b"sha1:" + warc.digest(b"payload 1").encode(), b"sha1:" + hashlib.sha1(b"payload 1").hexdigest().encode()).replace(b"X-Page-ID: 1", b"X-Page-ID: 5")
    files = {
        "cut": member(good[0]) + member(good[1])[:-30],
        "wrong": member(good[2].replace(b"payload 2", b"payload X")) + member(other) + member(b"WARC/1.1\r\nX-Page-ID: 8\r\n\r\n") + member(good[3]),
        "damaged": bytes(damaged) + member(good[0]),
    }
    for name, raw in files.items():
        (tmp_path / f"{name}.warc.gz").write_bytes(raw)
    got = warc.read_archives(warc.archive_files(spark, f"file://{tmp_path}"), split=64).collect()
    assert sorted((r.page_id, r.status) for r in got) == [("0", "ok"), ("0", "ok"), ("1", "truncated"), ("2", "mismatch"), ("3", "ok"), ("5", "ok"), ("8", "unreadable"), ("9", "truncated")]
