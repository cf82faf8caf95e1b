"""Membership tests that move no row: exact whatever the filter's size."""

import random

import pytest
from pyspark.sql import functions as F

from joblark.operators import membership
from joblark.operators.membership import Bloom
from joblark.plans import ingest as jobs
from joblark.plans.ingest import IngestOptions
from tests.test_ingest import as_of, ids, itviec, pages, topdev


def sample(spark, seed=1):
    rng = random.Random(seed)
    key = lambda: (rng.choice(["a", "b", None]), f"k{rng.randint(0, 900)}" if rng.random() < 0.95 else None)
    rows = spark.createDataFrame([(i, *key()) for i in range(2000)], "i int, s string, k string").repartition(5)
    keys = spark.createDataFrame(sorted({k for k in (key() for _ in range(700)) if None not in k}), "s string, k string")
    return rows, keys


@pytest.mark.parametrize("limit, max_bytes", [(10_000, 1 << 20), (100, 1 << 20), (400, 1)])
def test_without_members_equals_the_anti_join(spark, limit, max_bytes):
    rows, keys = sample(spark)
    got = membership.without_members(rows, keys, ("s", "k"), keys.count(), limit, ["i"], max_bytes)
    assert sorted(r.i for r in got.collect()) == sorted(r.i for r in rows.join(keys, ["s", "k"], "left_anti").collect())
    assert got.columns == ["s", "k", "i"] if limit == 10_000 else set(got.columns) == {"s", "k", "i"}


def test_too_many_false_hits_are_left_to_the_caller(spark):
    rows = spark.range(50_000).select(F.col("id").cast("string").alias("k"))
    keys = rows.where("k % 2 = 0")
    assert membership.without_members(rows, keys, ("k",), 25_000, 10, ["k"], max_bytes=8) is None


def test_a_filter_has_every_key_and_few_others(spark):
    keys = spark.range(20_000).select(F.concat(F.lit("job-"), F.col("id").cast("string")).alias("k"))
    others = spark.range(20_000, 60_000).select(F.concat(F.lit("job-"), F.col("id").cast("string")).alias("k"))
    bloom = Bloom.of(keys, ("k",), 20_000)
    assert bloom.flag(keys, "hit").where("hit").count() == 20_000
    assert bloom.flag(others, "hit").where("hit").count() < 40_000 * 0.03
    assert bloom.words.count() * membership.CHUNK_WORDS == bloom.n_words == 5 * membership.CHUNK_WORDS
    assert Bloom.of(keys, ("k",), 10**12, 1 << 16).n_bytes == 1 << 16


def test_no_keys(spark):
    rows, keys = sample(spark)
    assert membership.without_members(rows, keys.limit(0), ("s", "k"), 0, 0, ["i"]).count() == 2000
    assert membership.likely_members(rows, keys.limit(0), ("s", "k"), 0).count() == 0


def test_only_unknown_and_falsely_hit_pages_are_read(spark, store, monkeypatch):
    """Known ids beyond the broadcast: the records that are extracted are those of unknown ids."""
    known = [itviec(i) for i in range(40)] + [topdev(i) for i in range(40)]
    jobs.run(pages(spark, *known), jobs_sites(), store, options=IngestOptions(on_gate="reject"), as_of=as_of())
    read, write = [], jobs.write_table

    def counted(df, path):
        out = write(df, path)
        read.append(out.count())
        return out

    monkeypatch.setattr(jobs, "write_table", counted)
    more = pages(spark, *known, itviec(100), itviec(101), topdev(100))
    got = jobs.run(more, jobs_sites(), store, options=IngestOptions(broadcast_rows=20, on_gate="reject"), as_of=as_of())
    assert ids(got) == ["itviec_s100", "itviec_s101", "topdev_100"]
    assert read == [3]


def jobs_sites():
    from joblark.sources.sites import SITES

    return SITES


@pytest.mark.parametrize("rows", [0, 3])
def test_a_large_url_map_and_large_checks(spark, store, rows):
    """Whatever is too large to broadcast, the same pages are saved."""
    from joblark.operators import url_checks

    given = pages(spark, *(itviec(i) for i in range(20)))
    urls = given.where("job_id < 'itviec_s17'").select("source", "url", "job_id")
    log = given.select("source", "url", F.when(F.col("job_id") >= "itviec_s13", 404).otherwise(200).alias("status_code"), F.lit("").alias("reason"), F.lit("").alias("error_type"), F.lit("").alias("tb_str"))
    got = jobs.ingest(
        given, jobs_sites(), store, IngestOptions(broadcast_rows=rows, on_gate="reject"), checks=url_checks.check_urls(log).withColumn("source", F.lit("itviec")), urls=urls, as_of=as_of()
    )
    assert ids(got) == sorted(r.job_id for r in given.where("job_id < 'itviec_s13'").collect())
