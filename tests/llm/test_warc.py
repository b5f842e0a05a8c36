"""WARC archives: the standard's forms, predicates before payloads, and pages against brute force."""

import base64
import gzip
import hashlib
import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, IsNull, StringStartsWith

from civitas.llm import warc
from civitas.llm.common import scratch

PAGES = "page_id long, url string, html string"


def truth(rows, least=0):
    """page_id, bytes, digest, type and reference of each row, by the contract."""
    groups = {}
    for i, (page_id, _, html) in enumerate(rows):
        groups.setdefault((html or "").encode(), []).append((page_id is not None, page_id or 0, i))
    out = []
    for payload, members in groups.items():
        first = max(members)
        for known, page_id, i in members:
            response = len(payload) < least or (known, page_id, i) == first
            out.append((page_id if known else None, len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode(), "response" if response else "revisit", None if response or not first[0] else first[1]))
    return sorted(out, key=repr)


def trip(spark, rows, least=0, schema=PAGES):
    folder = scratch(spark)
    warc.write_pages(spark, spark.createDataFrame(rows, schema), f"{folder}/a", folder, least=least)
    got = warc.read_pages(spark, f"{folder}/a").collect()
    assert all(r.verified is (True if r.record_type == "response" else None) for r in got)
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=repr), f"{folder}/a"


@pytest.mark.parametrize("least", [0, 1, 40])
def test_pages_against_brute_force(spark, least):
    rng = random.Random(3)
    texts = [None, "", "\r\n\r\n", "WARC/1.1\r\nWARC-Type: response\r\n\r\n", "é" * 70_000, "<p>x</p>" * 9, "\x00\x1f\x8b\x08", *("".join(rng.choice("ab \n<>") for _ in range(rng.randint(0, 90))) for _ in range(20))]
    rows = [(i, f"http://h/{i}", rng.choice(texts)) for i in range(150)] + [(1000, None, "only"), (-5, "a b\nc", "negative"), (7, "u", "hot")] + [(2000 + i, "v", "hot") for i in range(200)]
    assert trip(spark, rows, least)[0] == truth(rows, least)


def test_repeated_and_null_ids(spark):
    rows = [(1, "a", "x"), (1, "a", "x"), (1, "b", "x"), (0, "c", "x"), (None, "d", "y"), (None, "d", "y"), (None, "e", "z"), (4, "f", "z"), (5, "g", "only")]
    got, _ = trip(spark, rows)
    assert got == truth(rows)
    assert sum(r[3] == "response" for r in got) == 4


def test_empty_table_and_other_columns(spark):
    assert trip(spark, [])[0] == []
    rows = [(1, "u", "x", "gone", "kept", 3), (2, "u", "x", None, None, 4)]
    got, _ = trip(spark, rows, schema=PAGES + ", record_type string, _key string, _tie int")
    assert [r[3:] for r in got] == [("revisit", 2), ("response", None)]


def test_archives_are_gzip_of_records(spark):
    rows = [(1, "http://a/ b", "eins"), (2, "http://a/2", "eins"), (3, "http://a/3", "zwei")]
    _, path = trip(spark, rows)
    names = [n for n in os.listdir(path) if n.endswith(".warc.gz")]
    whole = b"".join(gzip.open(f"{path}/{n}").read() for n in names)
    assert whole.count(b"WARC/1.1\r\n") == 3 + len(names) and whole.count(b"eins") == 1 and b"WARC-Target-URI: http://a/%20b\r\n" in whole
    reader = warc.opened(spark)
    records = {r.record_id: r for r in reader.load(path).where("type <> 'warcinfo'").collect()}
    revisit = next(r for r in records.values() if r.type == "revisit")
    assert records[revisit.refers_to].payload == b"eins" and revisit.payload is None and revisit.payload_bytes == 4
    assert revisit.headers["warc-profile"] == warc.PROFILE and revisit.payload_digest == records[revisit.refers_to].payload_digest


def test_predicates_are_taken_before_payloads(spark, monkeypatch):
    rows = [(i, f"http://h{i % 2}/", "x" * i) for i in range(50)]
    _, path = trip(spark, rows)
    few = warc.opened(spark).load(path).where((F.col("type") == "response") & F.col("target_uri").startswith("http://h1") & (F.col("payload_bytes") > 40))
    assert {len(r.payload) for r in few.collect()} == {41, 43, 45, 47, 49}
    assert "Filter" not in few._jdf.queryExecution().executedPlan().toString().replace("RuntimeFilters", "")
    reader = warc.WarcReader({"path": path})
    back = list(reader.pushFilters([EqualTo(("type",), "response"), IsNull(("payload",)), GreaterThan(("payload_bytes",), 40), StringStartsWith(("target_uri",), "http://h1")]))
    assert back == [IsNull(("payload",))]
    decoded = []
    monkeypatch.setattr(warc._Member, "block", lambda self, n, f=warc._Member.block: decoded.append(n) or f(self, n))
    assert sum(b.num_rows for p in reader.partitions() for b in reader.read(p)) == 5 and len(decoded) == 5


def foreign(tmp_path):
    """Records of another writer: plain, a member each, and one member for all."""
    one = lambda kind, block, more="": f"WARC/1.0\r\nWARC-Type: {kind}\r\n{more}WARC-Record-ID: <urn:uuid:{len(block)}>\r\nContent-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"
    http = b"HTTP/1.1 200 OK\r\nServer: x\r\n\r\n"
    records = [
        one("warcinfo", b"software: y\r\n"),
        one("response", http + b"body" * 100_000, "Content-Type: application/http;\r\n msgtype=response\r\n"),
        one("resource", b"plain \r\n\r\n WARC/1.0 text"),
        one("request", b"GET / HTTP/1.1\r\n\r\n", "Content-Type: application/http; msgtype=request\r\n"),
    ]
    (tmp_path / "in").mkdir()
    (tmp_path / "a.warc").write_bytes(b"".join(records))
    (tmp_path / "b.warc.gz").write_bytes(b"".join(map(gzip.compress, records)))
    (tmp_path / "in/c.warc.gz").write_bytes(gzip.compress(b"".join(records)))
    (tmp_path / "d.txt").write_text("no archive")
    return records


def test_archives_of_other_writers(spark, tmp_path):
    foreign(tmp_path)
    got = warc.opened(spark).load(str(tmp_path))
    assert sorted((r.type, r.n) for r in got.groupBy("type").agg(F.count(F.lit(1)).alias("n")).collect()) == [("request", 3), ("resource", 3), ("response", 3), ("warcinfo", 3)]
    assert {bytes(r.payload) for r in got.where("type = 'response'").collect()} == {b"body" * 100_000}
    assert {r.payload_bytes for r in got.where("type = 'response'").collect()} == {400_000}
    assert {bytes(r.payload) for r in got.where("type = 'resource'").collect()} == {b"plain \r\n\r\n WARC/1.0 text"}
    assert warc.opened(spark).load(str(tmp_path / "a.warc")).count() == 4


def test_broken_archives(spark, tmp_path):
    records = foreign(tmp_path)
    for name, data in (("a.warc", (tmp_path / "a.warc").read_bytes()), ("b.warc.gz", (tmp_path / "b.warc.gz").read_bytes())):
        (tmp_path / name).write_bytes(data[: len(data) - len(records[-1]) - 40 if name == "a.warc" else len(data) - 200])
    with pytest.raises(Exception, match="breaks? off"):
        warc.opened(spark).load(str(tmp_path / "a.warc")).count()
    kinds = sorted(r.type for r in warc.opened(spark).option("mode", "permissive").load(str(tmp_path / "a.warc")).select("type").collect())
    assert kinds[0] == "corrupt" and "response" in kinds
    assert warc.opened(spark).option("mode", "permissive").load(str(tmp_path / "b.warc.gz")).where("type = 'corrupt'").count() == 1


def test_files_end_and_appends_add(spark):
    rows = [(i, "http://h/", "x" * 500 + str(i), "response", None) for i in range(20)]
    path = f"{scratch(spark)}/a"
    pages = spark.createDataFrame(rows, PAGES + ", record_type string, refers_to long").coalesce(1)
    spark.dataSource.register(warc.WarcSource)
    for times in (1, 2):
        pages.write.format("warc").mode("append").option("fileBytes", 1000).save(path)
        manifest = [x.split(" ") for x in open(f"{path.removeprefix('file:')}/_manifest").read().splitlines()]
        assert len(manifest) > 4 * times and all(os.path.getsize(f"{path}/{n}") == int(size) for size, n in manifest)
        assert warc.opened(spark).load(path).where("type = 'response'").count() == 20 * times
    (lost := open(f"{path}/part-lost.warc.gz", "wb")).write(b"half of a file of a task that was lost")
    lost.close()
    assert warc.opened(spark).load(path).where("type = 'response'").count() == 40
