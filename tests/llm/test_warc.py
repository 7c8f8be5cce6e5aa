import base64
import gzip
import hashlib
import io
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from fairground.llm import warc
from fairground.llm.common import Scratch
from fairground.llm.queries import op12_warc

SCHEMA = "page_id long, url string, html string, record_type string, sha1 string"
LONG = "<p>long</p>" * 50_000
HTML = ["<a>", "<b>\r\n\r\nWARC/1.1\r\n\r\n", "<a>", None, "", "é<p>日本語", LONG, LONG, "<a>", "\r\n\r\n", "\0x"]


@pytest.fixture
def pages(spark):
    rows = [(100 - i if i % 2 else i, f"http://h/{i} x\r\n" if i % 3 else None, h, "old", "s") for i, h in enumerate(HTML)]
    return spark.createDataFrame(rows, SCHEMA)


def expected(rows):
    first = {}
    for r in rows:
        if r.page_id is not None:
            key = r.html or ""
            first[key] = min(first.get(key, r.page_id), r.page_id)
    out = []
    for r in rows:
        body = (r.html or "").encode()
        sha = base64.b32encode(hashlib.sha1(body).digest()).decode()
        least = first.get(r.html or "")
        again = r.page_id is not None and r.page_id != least
        out.append((r.page_id, len(body), sha, "revisit" if again else "response", least if again else None, None))
    return out


def order(row):
    return tuple((v is not None, v) for v in row)


@pytest.mark.parametrize("bound", [warc.BROADCAST_GROUPS, 0])
def test_pages_come_back(spark, pages, tmp_path, monkeypatch, bound):
    monkeypatch.setattr(warc, "BROADCAST_GROUPS", bound)
    odd = pages.union(pages.where("page_id in (2, 4)")).union(pages.limit(3).withColumn("page_id", F.lit(None).cast("long")))
    odd.write.parquet(f"{tmp_path}/pages.parquet")
    got = [tuple(r) for r in op12_warc(spark, str(tmp_path)).collect()]
    assert sorted(got, key=order) == sorted(expected(odd.collect()), key=order)


def test_empty_table(spark, pages):
    assert warc.archive_pages(spark, pages.limit(0)).count() == 0


def test_monolithic_files_and_members(spark, pages, tmp_path):
    archives = warc.write_archives(spark, pages, f"file://{tmp_path}/whole", archive_bytes=1 << 19)
    index = warc.normalise(spark, archives, f"file://{tmp_path}/members")
    assert archives.count() >= 2 and archives.agg(F.sum("records")).first()[0] == len(HTML)
    whole = b"".join(gzip.decompress(Path(r.archive[7:]).read_bytes()) for r in archives.collect())
    # The standard library reads one member from a monolithic file, and each record alone from its own.
    for r in archives.collect():
        data = Path(r.archive[7:]).read_bytes()
        unpack = __import__("zlib").decompressobj(31)
        unpack.decompress(data)
        assert unpack.eof and not unpack.unused_data
    members = {}
    for r in index.collect():
        data = Path(r.archive[7:]).read_bytes()
        one = gzip.decompress(data[r.offset : r.offset + r.length])
        assert one.startswith(b"WARC/1.1\r\n") and one.endswith(b"\r\n\r\n") and one in whole and r.error is None
        members.setdefault(r.archive, []).append((r.offset, r.length, one))
    for archive, rows in members.items():
        rows.sort()
        at = 0
        for offset, length, _ in rows:
            assert offset == at
            at += length
        assert at == len(Path(archive[7:]).read_bytes())
        assert gzip.decompress(Path(archive[7:]).read_bytes()) == b"".join(r[2] for r in rows)


def test_one_record_by_its_offset(spark, pages, tmp_path):
    index = warc.normalise(spark, warc.write_archives(spark, pages, f"file://{tmp_path}/whole"), f"file://{tmp_path}/members")
    one = warc.read_records(spark, index.where("record_id = 'urn:x-record:95'")).collect()
    assert [(r.payload.decode(), r.target_uri) for r in one] == [("é<p>日本語", "http://h/5%20x%0D%0A")]
    revisit = warc.read_records(spark, index.where("record_type = 'revisit' and refers_to = 'urn:x-record:0'")).collect()
    assert {r.record_id for r in revisit} == {"urn:x-record:2", "urn:x-record:8"} and all(r.payload is None and r.payload_bytes == 3 for r in revisit)
    assert index.where("target_uri is null and record_type = 'response'").count() >= 2


def test_members_are_taken_again(spark, pages, tmp_path):
    """An archive that is normal already, and one with padding between members, give the same records."""
    where = f"file://{tmp_path}"
    index = warc.normalise(spark, warc.write_archives(spark, pages.coalesce(1), f"{where}/whole"), f"{where}/members")
    source = Path(index.select("archive").first()[0][7:])
    rows = index.orderBy("offset").collect()
    padded = b"".join(source.read_bytes()[r.offset : r.offset + r.length] + b"\0" * (i % 3) for i, r in enumerate(rows))
    (tmp_path / "padded.gz").write_bytes(padded)
    again = warc.normalise(spark, spark.createDataFrame([(f"{where}/padded.gz",)], "archive string"), f"{where}/again")
    keys = ["record_id", "record_type", "target_uri", "payload_digest", "refers_to", "error"]
    assert sorted(map(str, again.select(keys).collect())) == sorted(map(str, index.select(keys).collect()))


@pytest.mark.parametrize("cut", [0.3, 0.999])
def test_damaged_archives_keep_what_stands_before(spark, pages, tmp_path, cut):
    where = f"file://{tmp_path}"
    archives = warc.write_archives(spark, pages.coalesce(1).where("length(html) < 100"), f"{where}/whole")
    data = Path(archives.first().archive[7:]).read_bytes()
    (tmp_path / "cut.gz").write_bytes(data[: int(len(data) * cut)])
    index = warc.normalise(spark, spark.createDataFrame([(f"{where}/cut.gz",)], "archive string"), f"{where}/cut")
    errors = index.where("error is not null").collect()
    assert len(errors) == 1 and errors[0].length is None and "cut.gz" in errors[0].error
    read = warc.read_records(spark, index).collect()
    assert len(read) == index.count() and sum(r.error is not None for r in read) == 1


def test_a_wrong_digest_is_told(spark, tmp_path):
    made = warc.record(b"response", [(b"WARC-Record-ID", b"<urn:a>"), (b"WARC-Payload-Digest", b"sha1:AAAA"), (b"Content-Type", b"application/http")], b"HTTP/1.1 200 OK\r\n\r\nbody")
    plain = warc.record(b"resource", [(b"WARC-Record-ID", b"<urn:b>")], b"a\r\n\r\nb")
    (tmp_path / "a.gz").write_bytes(gzip.compress(made + plain))
    index = warc.normalise(spark, spark.createDataFrame([(f"file://{tmp_path}/a.gz",)], "archive string"), f"file://{tmp_path}/out")
    rows = {r.record_id: r for r in warc.read_records(spark, index).collect()}
    assert rows["urn:a"].error.startswith("digest is") and rows["urn:a"].payload == b"body"
    assert rows["urn:b"].error is None and rows["urn:b"].payload == b"a\r\n\r\nb"


def test_streams_are_read_chunk_by_chunk(monkeypatch):
    monkeypatch.setattr(warc, "CHUNK", 7)
    whole = [warc.record(b"resource", [(b"WARC-Record-ID", b"<urn:%d>" % i)], b"\r\n" * i + b"x" * (97 * i)) for i in range(6)]
    got = [r for _, r in warc.records(io.BytesIO(gzip.compress(b"".join(whole))))]
    assert got == whole


def test_orphans_of_lost_attempts_are_not_read(spark, pages, tmp_path):
    where = f"file://{tmp_path}"
    archives = warc.write_archives(spark, pages, f"{where}/whole")
    (tmp_path / "whole" / "lost.warc.gz").write_bytes(b"half a file")
    index = warc.normalise(spark, archives, f"{where}/members")
    assert index.where("error is not null").count() == 0
    assert Scratch(spark, "x").base.startswith("file:")
