"""Page archives: ranges, records of others, round trips and streams."""

import io
import random
import zlib
from datetime import datetime, timezone

import pytest
from pyspark.errors import PySparkException

from joblark.operators.detail import extract_details
from joblark.schemas import DETAIL_PAGE
from joblark.sources import archive
from joblark.sources.sites import SITES
from joblark.sources.store import read_silver
from joblark.streaming.ingest_stream import start_ingest

AT = datetime(2024, 1, 2, 3, 4, 5, 678901, tzinfo=timezone.utc)
PIECES = ["<p>", "é", "WARC/1.0\r\n", "\r\n\r\n", "\n", "Content-Length: 3", "</p>", "語", "\x1f", " "]


def some_pages(n, seed=1):
    rng = random.Random(seed)
    text = lambda: "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 40)))
    odd = lambda v: rng.choice([v, v, v, None, "", f" {v}\r\nX: y", "<a b>", "%0A é"])
    return [
        {"source": odd("itviec"), "url": odd(f"https://x.test/{i}?a=%20"), "job_id": odd(f"j{i}"), "html": rng.choice([text(), text(), None]), "crawled_at": rng.choice([AT, None])}
        for i in range(n)
    ]


def packed(text):
    c = zlib.compressobj(6, zlib.DEFLATED, 31)
    return c.compress(text) + c.flush()


def as_rows(pages):
    return sorted((tuple(p[c] for c in DETAIL_PAGE.fieldNames()) for p in pages), key=repr)


def collected(df):
    rows = [r.asDict() for r in df.collect()]
    return as_rows([r | {"crawled_at": r["crawled_at"] and r["crawled_at"].astimezone(timezone.utc)} for r in rows])


@pytest.mark.parametrize("step", [1, 7, 100, 1000, 10**6])
def test_each_record_lies_in_one_range(step, monkeypatch):
    monkeypatch.setattr(archive, "_CHUNK", 300)
    pages = some_pages(30)
    data = b"".join(archive.to_member(p) for p in pages)
    got = [archive.to_page(r) for s in range(0, len(data), step) for r in archive.records(io.BytesIO(data), s, min(s + step, len(data)))]
    assert got == pages


def test_bytes_that_look_like_a_record_are_passed_over():
    # a stored body holds the bytes of a member, and one that is no record
    inner = packed(b"no record") + b"\x1f\x8b\x08 and no member"
    c = zlib.compressobj(0, zlib.DEFLATED, 31)
    first = c.compress(b"WARC/1.0\r\nWARC-Type: resource\r\nContent-Length: %d\r\n\r\n" % len(inner) + inner + b"\r\n\r\n") + c.flush()
    second = archive.to_member(some_pages(1)[0])
    for start in range(1, len(first) + 1):
        assert archive.first_record(io.BytesIO(first + second), start, 10**6) == len(first)


def test_records_of_other_writers():
    answer = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n<h1>a</h1>\xff"
    head = b"WARC/1.0\r\nwarc-type: response\r\nWARC-Target-URI: <https://x.test/a>\r\nWARC-Date: 2024-01-02T03:04:05Z\r\nContent-Length: %d\r\n\r\n"
    page = archive.to_page(head % len(answer) + answer + b"\r\n\r\n")
    assert page == {"source": None, "job_id": None, "url": "https://x.test/a", "html": "<h1>a</h1>�", "crawled_at": AT.replace(microsecond=0)}
    assert archive.to_page(b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n") is None
    assert archive.to_page(b"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Date: 2024\r\nContent-Length: 0\r\n\r\n")["crawled_at"] is None


def test_round_trip(spark, tmp_path):
    pages, folder = some_pages(300), str(tmp_path / "pages")
    df = spark.createDataFrame([tuple(p[c] for c in DETAIL_PAGE.fieldNames()) for p in pages], DETAIL_PAGE).repartition(3)
    archive.append_archive(df, folder)
    assert collected(archive.read_archive(spark, folder)) == as_rows(pages)
    small = archive.read_archive(spark, folder, range_bytes=2000)
    assert small.rdd.getNumPartitions() > 10 and collected(small) == as_rows(pages)
    archive.append_archive(df.limit(0), folder)
    archive.append_archive(df, folder)
    assert collected(archive.read_archive(spark, folder)) == as_rows(pages * 2)
    assert not [p for p in (tmp_path / "pages").iterdir() if p.name.startswith("_")]
    assert archive.read_archive(spark, str(tmp_path / "none")).count() == 0
    only = spark.read.format(archive.FORMAT).schema("url string").load(folder)
    assert only.columns == ["url"] and only.count() == 600
    with pytest.raises(PySparkException):
        df.write.format(archive.FORMAT).mode("overwrite").save(folder)
    with pytest.raises(PySparkException):
        df.drop("html").write.format(archive.FORMAT).mode("append").save(folder)


def test_a_record_that_ends_early_is_an_error(spark, tmp_path):
    member = archive.to_member(some_pages(1)[0])
    (tmp_path / "a.warc.gz").write_bytes(member + member[:-3])
    with pytest.raises(PySparkException, match="ends early"):
        archive.read_archive(spark, str(tmp_path)).collect()


def test_stream_resumes_at_its_offset(spark, tmp_path):
    folder, out = tmp_path / "pages", str(tmp_path / "out")
    folder.mkdir()
    pages = some_pages(90)
    members = [archive.to_member(p) for p in pages]

    def drain():
        stream = archive.archive_stream(spark, str(folder), range_bytes=1500)
        query = stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "checkpoint")).start(out)
        query.processAllAvailable()
        query.stop()
        return collected(spark.read.schema(DETAIL_PAGE).parquet(out))

    (folder / "b.warc.gz").write_bytes(b"".join(members[:30]))
    assert drain() == as_rows(pages[:30])
    # another archive, whose name comes first, and records added to the one that is known
    (folder / "a.warc.gz").write_bytes(b"".join(members[30:60]))
    with open(folder / "b.warc.gz", "ab") as f:
        f.write(b"".join(members[60:]))
    assert drain() == as_rows(pages)
    assert drain() == as_rows(pages)


def test_the_job_runs_on_archives(spark, store, tmp_path):
    html = '<html><h1 class="ipt-xl-6">Job {}</h1><div class="employer-name">Co</div></html>'
    rows = [("itviec", f"https://itviec.com/it-jobs/j-{i}", f"itviec_j-{i}", html.format(i), AT) for i in range(20)]
    table, folder = spark.createDataFrame(rows, DETAIL_PAGE), str(tmp_path / "pages")
    archive.append_archive(table.repartition(2), folder)
    read = archive.read_archive(spark, folder, range_bytes=500)
    assert sorted(map(str, extract_details(read, SITES).collect())) == sorted(map(str, extract_details(table, SITES).collect()))
    query = start_ingest(archive.archive_stream(spark, folder), SITES, store, str(tmp_path / "checkpoint"))
    query.awaitTermination()
    assert read_silver(spark, store).count() > 0
