"""Storage areas: raw JSONL, errors and the silver table."""

from __future__ import annotations

import json
import logging
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from joblark.operators.joins import BROADCAST_ROWS
from joblark.schemas import BRONZE, CLAIM, ERROR, OUTCOME, PROGRESS, REPORT, SILVER, SILVER_FILES, SILVER_PARTITION
from joblark.session import counted
from joblark.sources.turns import Turns

log = logging.getLogger(__name__)

FACT_TABLE = "fact_jobs"


@dataclass(frozen=True)
class Store:
    """Where the areas lie and what their catalog tables are called."""

    base: str
    schema: str = "jobs"
    silver_format: str = "parquet"

    @property
    def raws(self) -> str:
        return f"{self.base}/raws"

    @property
    def errors(self) -> str:
        return f"{self.base}/error"

    @property
    def outcomes(self) -> str:
        return f"{self.base}/outcomes"

    @property
    def reports(self) -> str:
        return f"{self.base}/reports"

    @property
    def claims(self) -> str:
        return f"{self.base}/claims"

    @property
    def progress(self) -> str:
        return f"{self.base}/progress"

    @property
    def silver(self) -> str:
        return f"{self.base}/silver/fact_jobs"

    def table(self, area: str) -> str:
        return f"{self.schema}.{area}"


# ---- fetched pages -----------------------------------------------------------------


def read_pages(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """A table of already fetched pages; the schema is given, never inferred."""
    return spark.read.format(fmt).schema(schema).load(path)


# ---- catalog set-up ----------------------------------------------------------------


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def ensure_schema(spark: SparkSession, store: Store) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {store.schema}")


def ensure_areas(spark: SparkSession, store: Store) -> None:
    """Catalog tables over the raw, error and silver areas; existing ones stay as they are."""
    for area, schema, path in (("raws", BRONZE, store.raws), ("error", ERROR, store.errors)):
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {store.table(area)} ({_ddl(schema)}) "
            f"USING json OPTIONS (recursiveFileLookup 'true') LOCATION '{path}'"
        )
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {store.table(FACT_TABLE)} ({_ddl(SILVER_FILES)}) "
        f"USING {store.silver_format} PARTITIONED BY ({SILVER_PARTITION}) LOCATION '{store.silver}'"
    )


def ensure_fact_table(spark: SparkSession, store: Store) -> None:
    """The empty silver files; those that exist are left untouched."""
    empty = spark.createDataFrame([], SILVER_FILES)
    empty.write.format(store.silver_format).partitionBy(SILVER_PARTITION).mode("ignore").save(store.silver)


def refresh_fact_table(spark: SparkSession, store: Store) -> None:
    """Let the catalog table see new days of silver."""
    spark.sql(f"MSCK REPAIR TABLE {store.table(FACT_TABLE)}")


def bootstrap(spark: SparkSession, store: Store) -> None:
    """The set-up job: schema, areas, fact table. Safe to run again."""
    ensure_schema(spark, store)
    ensure_fact_table(spark, store)
    ensure_areas(spark, store)
    refresh_fact_table(spark, store)


# ---- JSONL sinks -------------------------------------------------------------------


def append_jobs(records: DataFrame, store: Store, source: str, run_id: str | None = None, count: int | None = None) -> str:
    """Append the records of a source as new JSONL files; none for no records.

    With ``run_id`` the files go to a folder of that run, which a repeated
    attempt of the same run replaces. ``count`` is their number where it is known.
    """
    own = records.where(F.col("source") == source)
    if own.isEmpty() if count is None else not count:
        return ""
    path = f"{store.raws}/{source}"
    writer = own.write.option("ignoreNullFields", False)
    if run_id is None:
        writer.mode("append").json(path)
        return path
    writer.mode("overwrite").json(f"{path}/run_id={run_id}")
    return f"{path}/run_id={run_id}"


def overwrite_jobs(records: DataFrame, path: str) -> None:
    """Replace a JSONL folder; no records leave it as it is."""
    if not records.isEmpty():
        records.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def append_errors(errors: DataFrame, store: Store, run_id: str | None = None) -> bool:
    """Append error records. A failed write is logged and never fails the job."""
    path = store.errors if run_id is None else f"{store.errors}/run_id={run_id}"
    try:
        if not errors.isEmpty():
            mode = "append" if run_id is None else "overwrite"
            errors.select(*ERROR.fieldNames()).write.mode(mode).option("ignoreNullFields", False).json(path)
        return True
    except Exception:  # the error area must not take the job down with it
        log.exception("could not write error records to %s", path)
        return False


def read_jobs(spark: SparkSession, store: Store, source: str) -> DataFrame:
    path = f"{store.raws}/{source}"
    return spark.read.schema(BRONZE).option("recursiveFileLookup", True).json(path)


def read_errors(spark: SparkSession, store: Store, error_class: Column | None = None) -> DataFrame:
    """All error records, with their class where a rule for it is given."""
    found = spark.read.schema(ERROR).option("recursiveFileLookup", True).json(store.errors)
    return found if error_class is None else found.withColumn("error_class", error_class)


def read_run(spark: SparkSession, store: Store, sources: list[str], run_id: str) -> DataFrame:
    """What a run saved, from its raw files."""
    paths = [f"{store.raws}/{s}/run_id={run_id}" for s in sources]
    held = [p for p in paths if _exists(spark, p)]
    return spark.read.schema(BRONZE).json(held) if held else spark.createDataFrame([], BRONZE)


# ---- runs --------------------------------------------------------------------------
#
# A run settles what it will save in staged/<run>, claims its keys and a turn (turns.py), touches the
# sinks when its turn comes, then leaves a marker in committed/ and drops its staged folder. An attempt of a run
# that has claimed saves those very rows; one that finds the marker has nothing to do.


def _path(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def _exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _path(spark, path)
    return fs.exists(jpath)


def _put(spark: SparkSession, path: str, text: str = "") -> None:
    fs, jpath = _path(spark, path)
    out = fs.create(jpath, True)
    out.write(bytearray(text.encode()))
    out.close()


def drop(spark: SparkSession, path: str) -> None:
    fs, jpath = _path(spark, path)
    fs.delete(jpath, True)


def _staged_path(store: Store, run_id: str) -> str:
    return f"{store.base}/staged/{run_id}"


def write_area(rows: DataFrame, path: str, run_id: str) -> DataFrame:
    """A run's share of an area, replaced by a repeated attempt, as written."""
    rows.write.mode("overwrite").parquet(f"{path}/run_id={run_id}")
    return rows.sparkSession.read.schema(rows.schema).parquet(f"{path}/run_id={run_id}")


def write_report(report: DataFrame, store: Store, run_id: str) -> int:
    """The gate's report to its area. Returns how many batches failed, counted by the write."""
    seen = Observation()
    rows = report.withColumn("run_id", F.lit(run_id)).select(*REPORT.fieldNames())
    write_area(rows.observe(seen, F.count(F.when(~F.col("passed"), 1)).alias("failed")), store.reports, run_id)
    return seen.get["failed"]


@dataclass(frozen=True)
class Staged:
    """What is known of a run's staged rows, measured by the write that staged them."""

    rows: dict[str, int]  # a source
    first: date | None  # UTC days of fetch
    last: date | None

    @staticmethod
    def measures(sources: list[str]) -> list[Column]:
        day = utc_day(F.try_to_timestamp(F.col("crawled_at")))
        counts = [F.count(F.when(F.col("source") == s, 1)).alias(f"rows_{i}") for i, s in enumerate(sources)]
        return [*counts, F.min(day).cast("string").alias("first"), F.max(day).cast("string").alias("last")]

    @staticmethod
    def of(seen: dict, sources: list[str]) -> Staged:
        day = lambda at: at and date.fromisoformat(at)
        return Staged({s: seen[f"rows_{i}"] for i, s in enumerate(sources)}, day(seen["first"]), day(seen["last"]))


def stage_run(records: DataFrame, store: Store, run_id: str, sources: list[str]) -> DataFrame:
    """Write what a run will save before any sink is touched, and what the write saw beside it."""
    path, seen = f"{_staged_path(store, run_id)}/records", Observation()
    records.observe(seen, *Staged.measures(sources)).write.mode("overwrite").parquet(path)
    _put(records.sparkSession, f"{_staged_path(store, run_id)}/READY", json.dumps({"sources": sources, "seen": seen.get}))
    return records.sparkSession.read.schema(records.schema).parquet(path)


def staged_facts(spark: SparkSession, store: Store, run_id: str) -> Staged:
    """What the write of a run's staged rows saw, also for another attempt."""
    held = json.loads(spark.read.text(f"{_staged_path(store, run_id)}/READY", wholetext=True).first()["value"])
    return Staged.of(held["seen"], held["sources"])


def staged_run(spark: SparkSession, store: Store, run_id: str) -> DataFrame | None:
    path = _staged_path(store, run_id)
    return spark.read.parquet(f"{path}/records") if _exists(spark, f"{path}/READY") else None


def is_committed(spark: SparkSession, store: Store, run_id: str) -> bool:
    return _exists(spark, f"{store.base}/committed/{run_id}")


def commit_run(spark: SparkSession, store: Store, run_id: str, earlier: str | None = None) -> None:
    """Mark a run as saved and drop its staged rows, and the marker of an ``earlier`` run
    that cannot be attempted again."""
    _put(spark, f"{store.base}/committed/{run_id}")
    drop(spark, _staged_path(store, run_id))
    if earlier:
        drop(spark, f"{store.base}/committed/{earlier}")


def pending_runs(spark: SparkSession, store: Store, prefix: str) -> list[str]:
    """Runs of a name that are settled but not committed, from an attempt that failed."""
    fs, jpath = _path(spark, f"{store.base}/staged")
    if not fs.exists(jpath):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(jpath)]  # one entry a run that failed
    return sorted(n for n in names if n.startswith(prefix) and _exists(spark, f"{store.base}/staged/{n}/READY"))


def turns(spark: SparkSession, store: Store) -> Turns:
    return Turns(spark, f"{store.base}/turns")


def write_claim(staged: DataFrame, store: Store, run_id: str) -> DataFrame:
    """The keys a run is about to save, typed as in silver."""
    return write_area(to_silver(staged).select(*CLAIM.fieldNames()), store.claims, run_id)


def read_claims(spark: SparkSession, store: Store, run_ids: list[str]) -> DataFrame:
    return spark.read.schema(CLAIM).parquet(*(f"{store.claims}/run_id={r}" for r in run_ids))


def end_turns(spark: SparkSession, store: Store, run_id: str) -> None:
    """A saved run gives up its turns; keys of runs long past go."""
    for gone in set(turns(spark, store).saved(run_id)):
        drop(spark, f"{store.claims}/run_id={gone}")


def write_progress(spark: SparkSession, store: Store, run_id: str, turn: int, saved: dict[str, int]) -> None:
    """How many rows a run saved from each of its sources; another attempt replaces it."""
    rows = [json.dumps({"run_id": run_id, "source": s, "turn": turn, "saved": n}) for s, n in saved.items()]
    _put(spark, f"{store.progress}/{run_id}.json", "\n".join(rows) + "\n")


def read_progress(spark: SparkSession, store: Store) -> DataFrame:
    """What every run saved from every source, micro-batches of streams included."""
    return spark.read.schema(PROGRESS).json(store.progress)


def read_outcomes(spark: SparkSession, store: Store) -> DataFrame:
    """One row a page that a run has seen: what became of it, and in which run."""
    return spark.read.schema(OUTCOME).parquet(store.outcomes)


def read_reports(spark: SparkSession, store: Store) -> DataFrame:
    """The gate's reports of all runs."""
    return spark.read.schema(REPORT).parquet(store.reports)


# ---- silver ------------------------------------------------------------------------


def silver_files(spark: SparkSession, store: Store) -> DataFrame:
    """The silver files with their partition column; empty when not set up yet."""
    if not _exists(spark, store.silver):
        return spark.createDataFrame([], SILVER_FILES)
    return spark.read.format(store.silver_format).schema(SILVER_FILES).load(store.silver)


def read_silver(spark: SparkSession, store: Store) -> DataFrame:
    return silver_files(spark, store).select(*SILVER.fieldNames())


def utc_day(at: Column) -> Column:
    """The UTC date of a timestamp, whatever the session's zone."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(at) / F.lit(86400)).cast("int"))


def recent_silver(spark: SparkSession, store: Store, since: Column) -> DataFrame:
    """All silver rows crawled from a day on, and few older ones: partitions before
    it are not read. One day more covers sessions in other zones."""
    return silver_files(spark, store).where(F.col(SILVER_PARTITION) >= F.date_sub(since, 1))


def to_silver(records: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Raw records as typed rows; texts that are no date or time become null."""
    typed = {
        "posted_date": F.try_to_date(F.col("posted_date"), "yyyy-MM-dd"),
        "crawled_at": F.try_to_timestamp(F.col("crawled_at")),
        "ingested_at": ingested_at if ingested_at is not None else F.current_timestamp(),
    }
    return records.select(
        *(typed.get(n, F.col(n) if n in records.columns else F.lit(None)).cast(SILVER[n].dataType).alias(n)
          for n in SILVER.fieldNames())
    )


def load_silver(records: DataFrame, store: Store, days: tuple[date | None, date | None] | None = None) -> None:
    """Append raw records to silver, leaving out rows it already holds. ``days`` are the first and the last
    day of fetch where they are known.

    A row is one fetch of one page (id, URL, fetch time), so loading the same
    files again adds nothing. Only the days the records span are read back, and
    which rows are held is found on narrow columns first.
    """
    spark = records.sparkSession
    same = ["job_id", "url", "crawled_at"]
    rows = to_silver(records).withColumn(SILVER_PARTITION, utc_day(F.col("crawled_at")))
    low, high = days or rows.agg(F.min(SILVER_PARTITION), F.max(SILVER_PARTITION)).first()
    held = silver_files(spark, store)
    if low is not None:
        day = F.col(SILVER_PARTITION)
        held = held.where(day.between(F.lit(low), F.lit(high)) | day.isNull())
    fresh = rows.select(*same).distinct()
    held, n_held = counted(held.select(*same).join(fresh, [held[c].eqNullSafe(fresh[c]) for c in same], "left_semi"), "held")
    if n_held <= BROADCAST_ROWS:  # few rows are loaded again as a rule: whole rows stay where they are
        held = F.broadcast(held)
    match = [rows[c].eqNullSafe(held[c]) for c in same]
    (
        rows.join(held, match, "left_anti")
        .hint("rebalance", SILVER_PARTITION)
        .write.format(store.silver_format)
        .partitionBy(SILVER_PARTITION)
        .mode("append")
        .save(store.silver)
    )
