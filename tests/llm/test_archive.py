"""The content-addressed archive: record types by brute force, faults, and a round trip through WARC files."""

import hashlib
import re

import pytest

from sessionloom.llm import warc

SCHEMA = "page_id long, url string, html string, digest string, payload string, record long, copies int, head string, first string"


def table(spark, rows):
    return spark.createDataFrame([(i, u, h, "d", "p", 1, 2, "h", "f") for i, u, h in rows], SCHEMA)


@pytest.fixture(scope="module")
def rows():
    long = "ä" * 60 + "\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n"
    out = [(7, "http://a/", long), (3, "http://b/%20x", long), (5, None, long), (5, "u", long), (None, "http://c/", long), (None, None, None), (9, "http://d/\r\nWARC-Type: x", ""), (10, "e e", "x" * 99), (11, "e", "x" * 99), (12, "é", "x" * 100)]
    out += [(13, "f", "x" * 100), (14, "g", "y" * 300_000), (None, "h", "z" * 200), (None, "i", "z" * 200), (3, "http://b/%20x", long)]
    return out + [(1000 + k, f"http://h/{k}", "hot" * 50) for k in range(3000)]


def test_archive(spark, rows, tmp_path):
    warc.write(table(spark, rows), str(tmp_path / "a"))
    got = warc.pages(spark, str(tmp_path / "a")).collect()
    groups = {}
    for i, _, h in rows:
        groups.setdefault((h or "").encode(), []).append(i)
    assert sorted((str(r["page_id"]), str(r["url"]), bytes(r["payload"])) for r in got) == sorted((str(i), str(u), (h or "").encode()) for i, u, h in rows)
    responses = {}
    for r in got:
        body = bytes(r["payload"])
        assert r["payload_bytes"] == len(body) and r["payload_digest"] == hashlib.sha256(body).hexdigest()
        first = min((i for i in groups[body] if i is not None), default=None)
        if r["record_type"] == "response":
            responses[body] = responses.get(body, 0) + 1
            assert r["refers_to"] is None and (len(body) < 100 or r["page_id"] == first)
        else:
            assert r["record_type"] == "revisit" and len(body) >= 100 and r["refers_to"] == first
    assert all(n == (1 if len(b) >= 100 else len(groups[b])) for b, n in responses.items()) and len(responses) == len(groups)
    stored = spark.read.parquet(str(tmp_path / "a/payloads"))
    assert stored.count() == len(groups)


def test_files(spark, rows, tmp_path):
    warc.write(table(spark, rows), str(tmp_path / "a"))
    records = warc.records(spark, str(tmp_path / "a"))
    warc.write_files(records.repartition(3), str(tmp_path / "files"))
    got = warc.read_files(spark, str(tmp_path / "files")).collect()
    want = {bytes(r["head"]): bytes(r["warc"]) for r in records.collect()}
    assert len(want) == len(rows) and {bytes(r["head"]): bytes(r["head"]) + bytes(r["payload"]) + b"\r\n\r\n" for r in got} == want
    for head, whole in want.items():
        top = head[: head.index(b"\r\n\r\n") + 4]
        assert top.startswith(b"WARC/1.1\r\nWARC-Type: re") and int(re.search(rb"\r\nContent-Length: (\d+)\r\n", top)[1]) == len(whole) - len(top) - 4
        assert top.count(b"WARC-Type") == 1 or b"%0D%0AWARC-Type:%20x" in top
    assert len({re.search(rb"WARC-Record-ID: (.*)\r\n", h)[1] for h in want}) == len(rows)


def test_faults(spark, rows, tmp_path):
    path = str(tmp_path / "a")
    warc.write(table(spark, rows[:4]), path)
    sound = spark.read.parquet(path + "/payloads").collect()
    kind = spark.read.parquet(path + "/payloads").schema
    spark.createDataFrame([(r["digest"], r["payload"] + b"!", r["copies"], r["payload_bytes"]) for r in sound], kind).write.mode("overwrite").parquet(path + "/payloads")
    with pytest.raises(Exception, match="differs from its digest"):
        warc.pages(spark, path).collect()
    spark.createDataFrame([], kind).write.mode("overwrite").parquet(path + "/payloads")
    with pytest.raises(Exception, match="no payload"):
        warc.pages(spark, path).collect()


def test_empty(spark, tmp_path):
    warc.write(table(spark, []), str(tmp_path / "a"))
    assert warc.pages(spark, str(tmp_path / "a")).count() == 0
