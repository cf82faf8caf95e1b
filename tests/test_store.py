import json
from datetime import date, datetime, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from joblark.operators.url_checks import exception_record
from joblark.schemas import BRONZE, SILVER
from joblark.session import fill_cores, materialize, shared_dir
from joblark.sources import store as areas
from joblark.sources.store import Store


def job(i, posted="2024-03-01", crawled="2024-03-05T10:00:00+00:00", source="itviec"):
    return (f"{source}_{i}", "Kỹ sư", "c", "", "Hà Nội", None, posted, ["giờ"], "a\nb", source, f"https://x/{i}", crawled)


def jobs(spark, *rows):
    return spark.createDataFrame(list(rows), BRONZE)


def lines(path):
    return [line for f in sorted(Path(path).rglob("*.json")) for line in f.read_text(encoding="utf8").splitlines()]


def test_append_jobs(spark, store):
    assert areas.append_jobs(jobs(spark, job(1), job(2), job(9, source="topdev")), store, "itviec") == f"{store.raws}/itviec"
    areas.append_jobs(jobs(spark, job(3)), store, "itviec")
    found = [json.loads(line) for line in lines(f"{store.raws}/itviec")]
    assert sorted(r["job_id"] for r in found) == ["itviec_1", "itviec_2", "itviec_3"]
    assert list(found[0]) == BRONZE.fieldNames() and found[0]["working_method"] is None
    assert "Kỹ sư" in lines(f"{store.raws}/itviec")[0]  # not escaped
    assert areas.read_jobs(spark, store, "itviec").count() == 3


def test_no_file_for_no_records(spark, store):
    assert areas.append_jobs(jobs(spark, job(1)), store, "topdev") == ""
    assert not Path(f"{store.raws}/topdev").exists()
    areas.overwrite_jobs(jobs(spark), f"{store.base}/dev")
    assert not Path(f"{store.base}/dev").exists()


def test_a_batch_replaces_only_itself(spark, store):
    areas.append_jobs(jobs(spark, job(1)), store, "itviec", run_id="r0")
    areas.append_jobs(jobs(spark, job(2), job(3)), store, "itviec", run_id="r1")
    areas.append_jobs(jobs(spark, job(2), job(3)), store, "itviec", run_id="r1")
    assert sorted(r["job_id"] for r in areas.read_jobs(spark, store, "itviec").collect()) == ["itviec_1", "itviec_2", "itviec_3"]


def test_overwrite_jobs(spark, store):
    path = f"{store.base}/dev"
    areas.overwrite_jobs(jobs(spark, job(1), job(2)), path)
    areas.overwrite_jobs(jobs(spark, job(3)), path)
    areas.overwrite_jobs(jobs(spark), path)
    assert [json.loads(line)["job_id"] for line in lines(path)] == ["itviec_3"]


def test_errors(spark, store):
    error = exception_record(spark, ValueError("x"), "itviec", "main")
    assert areas.append_errors(error, store) and areas.append_errors(error, store)
    assert [tuple(r)[1:5] for r in areas.read_errors(spark, store).collect()] == [("itviec", "ValueError", "x", "main")] * 2


def test_a_failed_error_write_does_not_raise(spark, store, tmp_path):
    (tmp_path / "file").write_text("x")
    bad = Store(str(tmp_path / "file"))
    assert areas.append_errors(exception_record(spark, ValueError("x"), "s"), bad) is False


def test_bootstrap_is_idempotent(spark, store):
    areas.bootstrap(spark, store)
    assert areas.read_silver(spark, store).schema == SILVER
    assert areas.read_silver(spark, store).count() == 0
    areas.load_silver(jobs(spark, job(1)), store)
    areas.append_jobs(jobs(spark, job(1)), store, "itviec")
    areas.bootstrap(spark, store)
    assert areas.read_silver(spark, store).count() == 1
    assert sorted(t.name for t in spark.catalog.listTables(store.schema) if not t.isTemporary) == ["error", "fact_jobs", "raws"]
    spark.catalog.refreshTable(store.table("raws"))
    assert spark.table(store.table("raws")).select("job_id").collect()[0][0] == "itviec_1"


def test_typed_rows(spark):
    now = F.lit(datetime(2024, 4, 1))
    rows = [job(1), job(2, "30+ days ago"), job(3, "2024-99-99"), job(4, ""), job(5, None), job(6, "2024-02-29", "never")]
    got = {r["job_id"]: r for r in areas.to_silver(jobs(spark, *rows), now).collect()}
    assert areas.to_silver(jobs(spark, *rows)).columns == SILVER.fieldNames()
    assert got["itviec_1"]["posted_date"] == date(2024, 3, 1)
    assert all(got[f"itviec_{i}"]["posted_date"] is None for i in (2, 3, 4, 5))
    assert got["itviec_6"]["posted_date"] == date(2024, 2, 29) and got["itviec_6"]["crawled_at"] is None
    assert got["itviec_1"]["skills"] == ["giờ"]
    at = areas.to_silver(jobs(spark, job(1))).select(F.unix_seconds("crawled_at")).first()[0]
    assert at == int(datetime(2024, 3, 5, 10, tzinfo=timezone.utc).timestamp())
    site_2 = jobs(spark, job(1)).drop("working_method")
    assert areas.to_silver(site_2).first()["working_method"] is None


def test_loading_twice_adds_nothing(spark, store):
    rows = jobs(spark, job(1), job(1), job(2, crawled="2024-03-06T00:00:00+00:00"), job(3, crawled="never"))
    areas.load_silver(rows, store)
    areas.load_silver(rows, store)
    areas.load_silver(jobs(spark, job(1, crawled="2024-03-06T10:00:00+00:00")), store)  # fetched again later
    got = [r["job_id"] for r in areas.read_silver(spark, store).collect()]
    assert sorted(got) == ["itviec_1", "itviec_1", "itviec_1", "itviec_2", "itviec_3"]


def test_look_back_reads_only_its_days(spark, store):
    areas.load_silver(jobs(spark, job(1, crawled="2024-01-01T00:00:00+00:00"), job(2)), store)
    recent = areas.recent_silver(spark, store, F.lit(date(2024, 3, 1)))
    assert [r["job_id"] for r in recent.collect()] == ["itviec_2"]
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(crawled_date" in plan


def test_shared_folder(spark, tmp_path):
    base = spark.conf.get("spark.checkpoint.dir", None)
    path = shared_dir(spark, "x")
    assert base is None or path.startswith(base)
    assert shared_dir(spark, "x") != path
    df = materialize(spark.range(5), "five")
    assert df.inputFiles() and df.count() == 5


def test_small_scans_are_spread_and_large_ones_left_alone(spark, tmp_path):
    cores = spark.sparkContext.defaultParallelism
    spark.range(10).coalesce(1).write.parquet(str(tmp_path / "small"))
    spark.range(1000).repartition(cores * 4).write.parquet(str(tmp_path / "large"))
    small, large = (spark.read.parquet(str(tmp_path / n)) for n in ("small", "large"))
    assert "Exchange" in fill_cores(small, "id")._jdf.queryExecution().executedPlan().toString()
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", str(128 * 1024 * 1024))
    try:
        large = spark.read.parquet(str(tmp_path / "large"))
        assert fill_cores(large, "id") is large
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", before)
