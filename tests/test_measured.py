"""What writes measure, so that no further job has to: counts, days, failures, progress."""

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from joblark.operators import incremental as inc
from joblark.operators import quality
from joblark.plans import ingest as jobs
from joblark.session import counted, materialize
from joblark.sources import store as areas
from joblark.sources.sites import SITES
from tests.test_ingest import AT, drop, ingest, itviec, run_stream, topdev


@pytest.fixture
def jobs_of(spark):
    """How many Spark jobs an action starts."""
    sc, seen = spark.sparkContext, []

    def count(action):
        group = f"measured-{id(seen)}-{len(seen)}"
        seen.append(group)
        sc.setJobGroup(group, group)
        try:
            action()
        finally:
            sc.setLocalProperty("spark.jobGroup.id", None)
        return len(sc.statusTracker().getJobIdsForGroup(group))

    return count


@pytest.mark.parametrize("make", [
    lambda r: r, lambda r: r.limit(0), lambda r: r.where("k > 5000"), lambda r: r.select("k").distinct(),
    lambda r: r.join(r.where("id < 0").select("k").hint("merge"), "k"), lambda r: r.groupBy("k").count().repartition(7),
])
def test_counted_tables(spark, make, jobs_of):
    rows = make(spark.range(3000, numPartitions=5).withColumn("k", F.col("id") % 10))
    table, count = counted(rows, "counted")
    assert count == table.count() == rows.count()
    assert jobs_of(lambda: counted(rows, "counted")) == jobs_of(lambda: materialize(rows, "plain"))


def test_facts_of_staged_rows(spark, store):
    rows = [itviec(1), itviec(2, at=AT + timedelta(days=2)), itviec(3, at=AT - timedelta(days=1))]
    ingest(spark, store, *rows, run_id="a")
    records = areas.read_run(spark, store, ["itviec"], "a")
    areas.stage_run(records, store, "b", ["itviec", "topdev"])
    day = AT.date()
    assert areas.staged_facts(spark, store, "b") == areas.Staged({"itviec": 3, "topdev": 0}, day - timedelta(days=1), day + timedelta(days=2))
    areas.stage_run(records.where("crawled_at = ''"), store, "b", ["itviec"])
    assert areas.staged_facts(spark, store, "b") == areas.Staged({"itviec": 0}, None, None)
    areas.stage_run(records.withColumn("crawled_at", F.lit("no time")), store, "b", ["itviec"])
    assert areas.staged_facts(spark, store, "b") == areas.Staged({"itviec": 3}, None, None)


def test_sinks_are_not_asked_what_the_write_saw(spark, store, jobs_of):
    ingest(spark, store, itviec(1), run_id="a")
    records = areas.read_run(spark, store, ["itviec"], "a")
    nothing = areas.Staged({"itviec": 0, "topdev": 0}, None, None)
    assert jobs_of(lambda: jobs.save(records.limit(0), SITES, store, "b", nothing)) == 0
    assert jobs_of(lambda: areas.append_jobs(records, store, "topdev", "b", 0)) == 0
    asked = jobs_of(lambda: areas.append_jobs(records, store, "itviec", "b"))
    assert jobs_of(lambda: areas.append_jobs(records, store, "itviec", "b", 1)) < asked
    asked = jobs_of(lambda: areas.load_silver(records, store))
    assert jobs_of(lambda: areas.load_silver(records, store, (AT.date(), AT.date()))) < asked
    areas.load_silver(records, store, (AT.date(), AT.date()))
    assert areas.read_silver(spark, store).count() == 1


def test_a_report_without_failures_is_not_read(spark, store, jobs_of):
    counts = spark.createDataFrame([("a", 1, 4, 1), ("b", 1, 4, 4)], "source string, batch_no long, total long, bad long")
    report = quality.judged(counts, ["source", "batch_no"], F.lit("title"), F.lit(0.5))
    assert areas.write_report(report, store, "r") == 1
    assert areas.write_report(report.where("passed"), store, "s") == 0
    assert areas.write_report(report.limit(0), store, "t") == 0
    assert areas.read_reports(spark, store).count() == 3
    assert jobs_of(lambda: quality.enforce(report, 0)) == 0
    with pytest.raises(quality.DataQualityError):
        quality.enforce(report, 1)
    with pytest.raises(quality.DataQualityError):
        quality.enforce(report)


def progress(spark, store):
    rows = inc.batch_progress(areas.read_progress(spark, store).withColumnRenamed("turn", "batch_no"))
    return sorted((r.source, r.batch_no, r.total_batches, r.saved, r.total_saved) for r in rows.collect())


def test_progress_of_a_stream(spark, store):
    for rows in ((itviec(1), itviec(2), topdev(1)), (itviec(2), itviec(3)), (itviec(3),)):
        drop(spark, store, *rows)
        run_stream(spark, store)
    assert progress(spark, store) == [
        ("itviec", 1, 3, 2, 2), ("itviec", 2, 3, 1, 3), ("itviec", 3, 3, 0, 3),
        ("topdev", 1, 3, 1, 1), ("topdev", 2, 3, 0, 1), ("topdev", 3, 3, 0, 1),
    ]


def test_progress_counts_a_repeated_attempt_once(spark, store, monkeypatch):
    real = areas.commit_run
    monkeypatch.setattr(areas, "commit_run", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        ingest(spark, store, itviec(1), run_id="a")
    monkeypatch.setattr(areas, "commit_run", real)
    ingest(spark, store, itviec(1), run_id="a")
    ingest(spark, store, itviec(1), run_id="a")
    assert [(p[0], p[3], p[4]) for p in progress(spark, store)] == [("itviec", 1, 1), ("topdev", 0, 0)]
