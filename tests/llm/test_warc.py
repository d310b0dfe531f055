import gzip
import os

import pytest
from pyspark.sql import functions as F

from cartwise.llm import warc

PAGES = [(1, "http://a", "x" * 200), (2, "http://b\n", "x" * 200), (3, None, None), (4, "u", "y"),
         (5, "u", "y"), (None, "q", "x" * 200), (1, "http://a", "x" * 200), (6, "", ""),
         (7, "long", "é" * 300_000)]


@pytest.fixture(scope="module", params=[False, True], ids=["plain", "gzip"])
def archive(spark, request, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("warc") / "a")
    pages = spark.createDataFrame([(*p, "z") for p in PAGES],
                                  "page_id long, url string, html string, record_type string")
    warc.archive(pages, path, compress=request.param)
    return path


def test_pages_come_back(spark, archive):
    rows = warc.pages_back(warc.read_archive(spark, archive)).collect()
    assert len(rows) == len(PAGES)
    by = {(r.page_id, r.target_uri): r for r in rows}
    assert by[2, "http://b%0A"].record_type == "revisit" and by[2, "http://b%0A"].refers_to == 1
    assert by[2, "http://b%0A"].payload_bytes == 200
    assert by[2, "http://b%0A"].payload_digest == by[1, "http://a"].payload_digest
    assert by[1, "http://a"].record_type == "response" and by[None, "q"].record_type == "response"
    assert by[3, None].payload_bytes == 0 and by[7, "long"].payload_bytes == 600_000
    assert by[5, "u"].record_type == "response"  # too small for a revisit


def test_header_predicates_reach_the_reader(spark, archive):
    read = warc.read_archive(spark, archive)
    q = read.where("record_type = 'revisit' AND target_uri LIKE 'http%' AND content_length <= 5")
    assert "Filter (" not in q._jdf.queryExecution().executedPlan().toString()
    assert q.count() == 1
    assert read.where(F.col("target_uri").isin("u", "q")).count() == 3
    assert read.where("target_uri IS NULL").count() == 1
    assert warc.read_archive(spark, archive, **{"header.X-Page-Id": "4"}).count() == 1


def test_unwanted_payloads_are_not_decoded(spark, archive):
    none = warc.read_archive(spark, archive, payload="none").collect()
    assert len(none) == len(PAGES) and all(r.payload is None for r in none)
    some = warc.read_archive(spark, archive, payload="response").collect()
    assert all((r.payload is None) == (r.record_type == "revisit") for r in some)


def test_files_that_no_commit_names_are_not_read(spark, archive):
    before = warc.read_archive(spark, archive).count()
    with open(os.path.join(archive, "part-00000-lost.warc"), "wb") as f:
        f.write(b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 1\r\n\r\nx\r\n\r\n")
    assert warc.read_archive(spark, archive).count() == before


def test_archives_from_elsewhere(spark, tmp_path):
    record = (b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
              b"WARC/1.0\r\nWARC-Type: resource\r\nX-Long: one\r\n two\r\ncontent-length: 4\r\n\r\n\r\n\r\n\r\n\r\n")
    (tmp_path / "a.warc").write_bytes(record)
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(record[:62]) + gzip.compress(record[62:]))
    rows = warc.read_archive(spark, str(tmp_path)).collect()
    assert sorted(r.record_type for r in rows) == ["resource", "resource", "warcinfo", "warcinfo"]
    assert {bytes(r.payload) for r in rows} == {b"abc", b"\r\n\r\n"}
    assert {r.headers.get("X-Long") for r in rows} == {None, "one two"}


def test_many_partitions_and_empty(spark, tmp_path):
    pages = spark.range(500).select(F.col("id").alias("page_id"), F.lit("u").alias("url"),
                                    F.concat(F.repeat(F.lit("h"), 5000), "id").alias("html"))
    path = str(tmp_path / "many")
    warc.register(spark)
    (warc.page_records(pages).coalesce(1).write.format("warc").mode("append")
     .option("markBytes", 100_000).option("fileBytes", 1_000_000).save(path))
    read = warc.read_archive(spark, path, splitBytes=200_000)
    assert read.rdd.getNumPartitions() > 5
    assert warc.pages_back(read).select("page_id").distinct().count() == 500
    warc.archive(pages.limit(0), str(tmp_path / "none"))
    assert warc.read_archive(spark, str(tmp_path / "none")).count() == 0
