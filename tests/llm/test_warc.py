"""Archives: round trips, revisits, pushed predicates and foreign files."""

import gzip
import hashlib
import os

import pytest
from pyspark.sql import functions as F

from gridzonal.llm import warc
from gridzonal.storage import fresh_path

LONG = "<html>" + "x" * 200
PAGES = [
    (1, "http://a/1", LONG), (2, "http://a/2", LONG), (3, None, "short"), (4, "http://b/4", "short"), (5, "http://b/5", None),
    (6, "http://b/6", ""), (7, "u\r\nWARC-Type: fake", "é" * 50), (9, "u%0A9", "é" * 50), (8, "u", "é" * 49), (1, "http://a/1", LONG),
    (None, "none", LONG), (-4, "neg", "y" * 99), (-5, "neg", "y" * 99 + "\r\n\r\n"), (10, "big", "z" * 300_000 + "\r\n\r\n<p>"),
]
SCHEMA = "page_id bigint, url string, html string"


def expected():
    first = {}
    for number, _u, html in PAGES:
        data = (html or "").encode()
        if len(data) >= 100 and number is not None:
            first[data] = min(first.get(data, number), number)
    out = []
    for number, _u, html in PAGES:
        data = (html or "").encode()
        again = data in first and number != first[data]
        digest = hashlib.sha256(data).hexdigest()
        out.append((number, len(data), digest, "revisit" if again else "response", first[data] if again else None))
    return out


COLUMNS = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def test_page_archive(spark):
    pages = spark.createDataFrame(PAGES, SCHEMA).withColumn("digest", F.lit("clash")).repartition(3)
    found = [tuple(r[c] for c in COLUMNS) for r in warc.page_archive(pages).collect()]
    assert sorted(found, key=str) == sorted(expected(), key=str)
    assert warc.page_archive(pages.limit(0)).isEmpty()


@pytest.fixture(scope="module")
def archive(spark):
    path = fresh_path(spark, "warc")
    warc.write_warc(warc.records_of_pages(spark.createDataFrame(PAGES, SCHEMA).repartition(2)), path)
    return path


def test_predicates_reach_the_reader(spark, archive):
    read = warc.read_warc(spark, archive)
    some = read.filter("record_type = 'revisit' AND target_uri LIKE 'http://a/%'")
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert " Filter " not in plan  # both conditions are the reader's
    assert {r.target_uri for r in some.collect()} == {"http://a/2"}
    assert read.filter("record_id IN ('<urn:page:3>', '<urn:page:4>')").count() == 2
    assert read.filter(F.col("payload").isNotNull()).count() > 0
    assert warc.read_warc(spark, archive, payload=False).filter("payload IS NOT NULL").count() == 0
    assert read.filter("record_id = '<urn:page:7>'").first().target_uri == "u\r\nWARC-Type: fake"


def test_unwanted_payloads_are_not_decoded(archive, monkeypatch):
    reader = warc.WarcReader(archive, payload=True)
    left = list(reader.pushFilters([warc.EqualTo(("record_id",), "<urn:page:10>"), warc.EqualTo(("payload_length",), 3)]))
    assert [f.attribute for f in left] == [("payload_length",)]
    rows = [b for part in reader.partitions() for b in reader.read(part)]
    assert sum(b.num_rows for b in rows) == 1
    inflated = []

    class Counting:
        def __init__(self, inner):
            self.inner = inner

        def decompress(self, *args):
            out = self.inner.decompress(*args)
            inflated.append(len(out))
            return out

        def __getattr__(self, name):
            return getattr(self.inner, name)

    real = warc.zlib.decompressobj
    monkeypatch.setattr(warc.zlib, "decompressobj", lambda *a: Counting(real(*a)))
    reader = warc.WarcReader(archive, payload=True)
    list(reader.pushFilters([warc.EqualTo(("record_type",), "none")]))
    assert not [b for part in reader.partitions() for b in reader.read(part)]
    assert sum(inflated) < 3000 * len(PAGES)  # the large payload has 300,000 bytes


def test_members_are_gzip_and_failed_attempts_are_ignored(spark, archive):
    folder = archive.removeprefix("file:")
    names = [n for n in os.listdir(folder) if n.endswith(".gz")]
    text = b"".join(gzip.open(f"{folder}/{n}").read() for n in names)
    assert text.count(b"WARC/1.1\r\n") == len(PAGES)
    with open(f"{folder}/part-99999-lost.warc.gz", "wb") as out:
        out.write(b"torn")
    assert warc.read_warc(spark, archive).count() == len(PAGES)


def test_files_of_other_writers(spark, tmp_path):
    body = b"HTTP/1.1 200 OK\r\nContent-Length: 5\r\n\r\nhello"
    head = b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:77>\r\nContent-Length: %d\r\n\r\n" % len(body)
    with open(tmp_path / "other.warc.gz", "wb") as out:
        for _ in range(3):
            out.write(gzip.compress(head + body + b"\r\n\r\n"))
    found = warc.read_warc(spark, f"file://{tmp_path}").collect()
    assert [(r.record_id, bytes(r.payload), r.payload_length) for r in found] == [("<urn:page:77>", b"hello", 5)] * 3


def test_appends_keep_what_is_there(spark):
    path = fresh_path(spark, "twice")
    pages = spark.createDataFrame(PAGES, SCHEMA)
    for _ in range(2):
        warc.write_warc(warc.records_of_pages(pages), path)
    assert warc.read_warc(spark, path).count() == 2 * len(PAGES)
    assert warc.read_warc(spark, path).filter("record_type = 'revisit'").count() == 2 * sum(r[3] == "revisit" for r in expected())


@pytest.mark.parametrize("body", [b"software: x\r\nformat: y\r\n", b"", b"a\r\n\r\nb", b"m" * 5000])
def test_records_without_http(spark, tmp_path, body):
    head = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: %d\r\n\r\n" % len(body)
    with open(tmp_path / "info.warc.gz", "wb") as out:
        for _ in range(2):
            out.write(gzip.compress(head + body + b"\r\n\r\n"))
    found = warc.read_warc(spark, str(tmp_path)).collect()
    assert [(r.record_type, bytes(r.payload), r.payload_length) for r in found] == [("warcinfo", body, len(body))] * 2


def test_paths_are_those_of_the_session(spark):
    configuration = spark._jsc.hadoopConfiguration()
    before = configuration.get("fs.defaultFS")
    pages = spark.createDataFrame(PAGES[:2], SCHEMA)
    path = fresh_path(spark, "own")
    warc.write_warc(warc.records_of_pages(pages), path)
    try:
        configuration.set("fs.defaultFS", "hdfs://nowhere.invalid:1/")
        with pytest.raises(Exception, match="nowhere.invalid"):
            warc.read_warc(spark, path).collect()
        assert warc.read_warc(spark, f"file://{path}").count() == 2
    finally:
        configuration.set("fs.defaultFS", before or "file:///")
