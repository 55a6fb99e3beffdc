import gzip
import os
import re

import pytest

from candlewick.llm import warc as W

PAGES = "page_id long, url string, html string, record_type string"


@pytest.fixture
def archive(spark, tmp_path):
    def make(rows, **options):
        pages = spark.createDataFrame([(i, u, h, "x") for i, u, h in rows], PAGES).repartition(3)
        W.write_warc(pages, f"file://{tmp_path}/w", **options)
        return f"file://{tmp_path}/w"

    return make


def test_round_trip(spark, archive):
    rows = [(5, "http://a", "<p>é</p>"), (3, "http://b\r\nx", "<p>é</p>"), (9, None, None), (2, "", ""), (7, "u", "x" * 300_000), (3, "http://b\r\nx", "<p>é</p>")]
    out = W.read_warc(spark, archive(rows)).collect()
    got = {(r.record_id, r.target_uri, r.record_type, r.refers_to, r.payload_bytes, None if r.payload is None else bytes(r.payload).decode()) for r in out}
    assert len(out) == 6
    assert got == {
        ("<urn:page:3>", "http://b%0D%0Ax", "response", None, 9, "<p>é</p>"),
        ("<urn:page:5>", "http://a", "revisit", "<urn:page:3>", 9, None),
        ("<urn:page:2>", "", "response", None, 0, ""),
        ("<urn:page:9>", None, "revisit", "<urn:page:2>", 0, None),
        ("<urn:page:7>", "u", "response", None, 300_000, "x" * 300_000),
    }
    assert all(r.payload_digest == f"sha1:{W.digest(bytes(r.payload))}" for r in out if r.payload is not None)


def test_small_payloads_are_responses(spark, archive):
    out = W.read_warc(spark, archive([(1, "a", "xy"), (2, "b", "xy"), (3, "c", "xyz"), (4, "d", "xyz")], min_bytes=3)).collect()
    assert sorted((r.record_id, r.record_type) for r in out) == [("<urn:page:1>", "response"), ("<urn:page:2>", "response"), ("<urn:page:3>", "response"), ("<urn:page:4>", "revisit")]


def test_null_ids(spark, archive):
    out = W.read_warc(spark, archive([(None, "a", "x"), (4, "b", "x"), (None, "c", "y")])).collect()
    assert sorted((r.target_uri, r.record_type, r.refers_to) for r in out) == [("a", "revisit", "<urn:page:4>"), ("b", "response", None), ("c", "response", None)]


def test_empty_table(spark, archive):
    assert W.read_warc(spark, archive([])).count() == 0


def test_predicates_reach_the_source(spark, archive):
    folder = archive([(i, f"http://h{i % 3}/{i}", f"<p>{i % 10}</p>") for i in range(40)])
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        df = W.read_warc(spark, folder).where("record_type = 'response' AND target_uri LIKE 'http://h1/%'")
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"\bFilter\b", plan) is None
        assert sorted(r.record_id for r in df.collect()) == ["<urn:page:1>", "<urn:page:4>", "<urn:page:7>"]
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def test_other_writers_members(spark, tmp_path):
    """No length in the gzip header, folded and unknown fields, records that are no HTTP messages."""
    one = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <a>\r\nX-Long: b\r\n c\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    two = W.record("response", "<b>", b"y" * 200_000, "http://x", "2020-01-01T00:00:00Z", None)
    (tmp_path / "x.warc.gz").write_bytes(gzip.compress(one) + gzip.compress(two) + gzip.compress(one))
    for payload in ("keep", "check", "skip"):
        out = W.read_warc(spark, f"file://{tmp_path}", payload).collect()
        assert [(r.record_id, r.payload_bytes, r.http_status) for r in sorted(out, key=lambda r: r.offset)] == [("<a>", 5, None), ("<b>", 200_000, 200), ("<a>", 5, None)]
        assert all((r.payload is not None) == (payload == "keep") for r in out)


def test_unwanted_payloads_are_not_inflated(tmp_path, monkeypatch):
    data = b"".join(W.member(W.record("response", f"<{i}>", bytes([i]) * 500_000, None, "d", None)) for i in range(3))
    (tmp_path / "x.warc.gz").write_bytes(data)
    reader = W.WarcReader({"path": str(tmp_path), "payload": "skip"})
    inflated = []
    more = W.Member.more
    monkeypatch.setattr(W.Member, "more", lambda self: inflated.append(1) or more(self))
    rows = [b for p in reader.partitions() for b in reader.read(p)]
    assert sum(b.num_rows for b in rows) == 3 and len(inflated) <= 6


def test_files_are_read_once(tmp_path, monkeypatch):
    data = b"".join(W.member(W.record("response", f"<{i}>", b"%d" % i * 200, "http://x", "d", None)) for i in range(2000))
    (tmp_path / "x.warc.gz").write_bytes(data)
    made = []
    init = W.Buffered.__init__
    monkeypatch.setattr(W.Buffered, "__init__", lambda self, stream: made.append(self) or init(self, stream))
    for payload in ("keep", "skip"):
        made.clear()
        reader = W.WarcReader({"path": str(tmp_path), "payload": payload})
        rows = [b for p in reader.partitions() for b in reader.read(p)]
        assert sum(b.num_rows for b in rows) == 2000
        assert sum(m.bytes_read for m in made) <= 1.1 * len(data)


@pytest.mark.parametrize("own_lengths", [True, False])
def test_large_archives_are_split_between_tasks(tmp_path, own_lengths):
    import gzip

    records = [W.record("response", f"<{i}>", os.urandom(50 + 977 * (i % 9)), "http://x", "d", None) for i in range(120)]
    records.insert(60, W.record("response", "<long>", os.urandom(60_000) + b"\x1f\x8b\x08" * 50, "http://x", "d", None))
    data = b"".join(W.member(r) if own_lengths else gzip.compress(r) for r in records)
    (tmp_path / "x.warc.gz").write_bytes(data)
    reader = W.WarcReader({"path": str(tmp_path), "task_bytes": "7000"})
    parts = reader.partitions()
    assert len(parts) > len(data) // 7000
    rows = [r for p in parts for b in reader.read(p) for r in b.to_pylist()]
    assert len(rows) == 121 and sorted(r["record_id"] for r in rows) == sorted([f"<{i}>" for i in range(120)] + ["<long>"])
    assert [r["offset"] for r in rows] == sorted(r["offset"] for r in rows)


def test_damage_is_an_error(spark, tmp_path):
    record = W.record("response", "<a>", b"abc", None, "d", None)
    (tmp_path / "x.warc.gz").write_bytes(W.member(record.replace(b"abc", b"abd")))
    with pytest.raises(Exception, match="does not have its digest"):
        W.read_warc(spark, str(tmp_path), "check").collect()
    (tmp_path / "x.warc.gz").write_bytes(W.member(record)[:60])
    with pytest.raises(Exception, match="cut off"):
        W.read_warc(spark, str(tmp_path)).collect()


def test_files_are_bounded(spark, archive, tmp_path):
    import os

    folder = archive([(i, "u", str(i) * 500) for i in range(200)], file_bytes=2000)
    assert W.read_warc(spark, folder).count() == 200
    assert max(os.path.getsize(f"{tmp_path}/w/{f}") for f in os.listdir(f"{tmp_path}/w") if not f.endswith(".crc")) < 3000
