"""The ingestion job: pages in, gated records, their outcomes and errors out."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from joblark.functions.dates import key_date
from joblark.functions.text import or_empty
from joblark.operators import detail, incremental, listing, membership, quality, url_checks
from joblark.operators.joins import BROADCAST_ROWS, Join, sized_join, skew_join
from joblark.schemas import BRONZE, CLAIM
from joblark.session import counted, materialize, shared_dir, write_table
from joblark.sources import store as areas
from joblark.sources.spec import SourceSpec, of_sources, per_source
from joblark.sources.store import Staged, Store

_GIVEN = ("job_id", "source", "url", "crawled_at")  # columns every site's record has

# What becomes of a page: saved, or why not. Beside these the reasons of detail and triage.
SAVED = "saved"
NOT_LISTED = "not_listed"
URL_FAILED = "url_failed"
KNOWN_ID = "known_id"
REPEATED = "repeated_key"
GATE_FAILED = "gate_failed"


@dataclass(frozen=True)
class IngestOptions:
    """``mode="id"`` drops a known id whatever its date, ``"id_date"`` only a known
    pair. ``on_gate="raise"`` stops a run with a failed batch before anything is saved,
    ``"reject"`` leaves the batch out. ``lease`` is the time in seconds after which a run that shares the store and
    has not ended its save counts as lost; it has to exceed the longest save."""

    mode: str = "id"
    on_gate: str = "raise"
    broadcast_rows: int = BROADCAST_ROWS
    filter_bytes: int = membership.MAX_BYTES
    lease: float = 6 * 3600.0

    def join(self, *args) -> DataFrame:
        return sized_join(*args, limit=self.broadcast_rows)

    def known_join(self, count: int) -> Join:
        """A join with a right side of known size."""
        if count > self.broadcast_rows:
            return skew_join
        return lambda left, right, on, how, spread: left.join(F.broadcast(right), on, how)


def crawl_frontier(
    pages: DataFrame, specs: tuple[SourceSpec, ...], max_pages: int = 0
) -> DataFrame:
    """Listing pages to ``(source, slug, url, job_id)``; the HTML is parsed once."""
    facts = materialize(listing.listing_facts(pages, specs), "listing")
    listing.require_first_pages(facts, specs)
    return listing.url_id_map(listing.frontier(facts, max_pages), specs)


def fresh_records(
    pages: DataFrame, keys: DataFrame, specs: tuple[SourceSpec, ...], options: IngestOptions = IngestOptions()
) -> DataFrame:
    """Records of the pages whose id is not known, with ``page_reject``.

    Pages are never shuffled, and known ids drop them before their HTML is read: few ids are
    broadcast, many through a filter of bounded size whose false hits are settled on ids. Only when those
    are too many as well are ids joined with the extracted records instead.
    """
    if options.mode == "id_date":
        return detail.extract_details(pages, specs)
    if options.mode != "id":
        raise ValueError(f"unknown mode: {options.mode}")
    ids = keys.select("job_id").distinct()
    left = membership.without_members(pages, ids, ("job_id",), keys.count(), options.broadcast_rows, ["url"], options.filter_bytes)
    if left is not None:
        return detail.extract_details(left, specs)
    return incremental.new_ids(materialize(detail.extract_details(pages, specs), "extracted"), keys, ["url"])


def failed_urls(checks: DataFrame, specs: tuple[SourceSpec, ...]) -> DataFrame:
    """Distinct ``(source, url)`` of failed checks, for sources that check URLs."""
    _, failures = url_checks.partition_urls(checks)
    checking = [s.name for s in specs if s.check_urls]
    return failures.where(F.col("source").isin(*checking)).select("source", "url").distinct()


def triaged(
    pages: DataFrame, keys: DataFrame, specs: tuple[SourceSpec, ...], options: IngestOptions
) -> DataFrame:
    """Records with ``reject_reason``, written once so that the HTML is read once."""
    records = fresh_records(pages, keys, specs, options)
    keyed = records.withColumn("key_date", or_empty(key_date(F.col("posted_date"))))
    written = materialize(keyed, "records")
    return incremental.triage(written, keys, ["url"], options.join)


def save(records: DataFrame, specs: tuple[SourceSpec, ...], store: Store, run_id: str, staged: Staged) -> None:
    """Raw JSONL per source, then silver."""
    if not any(staged.rows.values()):
        return
    for spec in specs:
        columns = [n for n in BRONZE.fieldNames() if n in spec.fields or n in _GIVEN]
        own = records.where(F.col("source") == spec.name).select(*columns)
        areas.append_jobs(own, store, spec.name, run_id, staged.rows[spec.name])
    areas.load_silver(records, store, (staged.first, staged.last))


def silver_keys(spark: SparkSession, store: Store, specs: tuple[SourceSpec, ...] | None = None,
                as_of: Column | None = None, days: int = incremental.LOOK_BACK_DAYS, claimed: list[str] | None = None) -> DataFrame:
    """Recent keys of the silver files and of ``claimed`` runs, of the run's sources; the look-back prunes partitions too."""
    today = as_of if as_of is not None else F.current_date()
    recent = areas.recent_silver(spark, store, F.date_sub(today, days)).select(*CLAIM.fieldNames())
    if claimed:
        recent = recent.unionByName(areas.read_claims(spark, store, claimed))
    return incremental.recent_keys(recent.where(of_sources(specs)) if specs else recent, as_of, days)


@dataclass(frozen=True)
class Filter:
    """A narrow table, written and counted once, that leaves out pages it holds or lacks."""

    rows: DataFrame
    on: tuple[str, ...]
    outcome: str
    keep_held: bool  # pages it holds go on, others go
    count: int

    @staticmethod
    def of(rows: DataFrame, on: tuple[str, ...], outcome: str, keep_held: bool = False) -> Filter:
        written, count = counted(rows.select(*on).distinct(), outcome)
        return Filter(written, on, outcome, keep_held, count)

    def flag(self, df: DataFrame, name: str, limit: int) -> DataFrame:
        marked = self.rows.withColumn(name, F.lit(True))
        if self.count <= limit:
            return df.join(F.broadcast(marked), [*self.on], "left")
        return skew_join(df, marked, [*self.on], "left", ["url", "crawled_at"])


    def narrowed(self, pages: DataFrame, options: IngestOptions) -> tuple[DataFrame, bool]:
        """Pages without those that the filter surely stops, and whether it stops none of the rest."""
        if self.keep_held:
            return membership.likely_members(pages, self.rows, self.on, self.count, options.filter_bytes), False
        left = membership.without_members(
            pages, self.rows, self.on, self.count, options.broadcast_rows, ["url", "crawled_at"], options.filter_bytes
        )
        return (pages, False) if left is None else (left, True)


def filtered(df: DataFrame, filters: list[Filter], limit: int) -> DataFrame:
    """``df`` with the outcome of the first filter that stops a row, else null, in ``early``."""
    for i, f in enumerate(filters):
        df = f.flag(df, f"_f{i}", limit)
    early = F.coalesce(
        *(F.when(F.col(f"_f{i}").isNull() if f.keep_held else F.col(f"_f{i}"), F.lit(f.outcome)) for i, f in enumerate(filters)),
        F.lit(None).cast("string"),
    )
    return df.withColumn("early", early).drop(*(f"_f{i}" for i in range(len(filters))))


def site_batches(pages: DataFrame, specs: tuple[SourceSpec, ...]) -> DataFrame:
    """``(source, url, batch_no)``: distinct URLs of some pages in batches of their site's size."""
    urls = pages.select("source", "url").distinct()
    return incremental.assign_batches(urls, per_source(specs, lambda s: F.lit(s.batch_size)))


def ingest(
    pages: DataFrame,
    specs: tuple[SourceSpec, ...],
    store: Store,
    options: IngestOptions = IngestOptions(),
    checks: DataFrame | None = None,
    urls: DataFrame | None = None,
    as_of: Column | None = None,
    run_id: str | None = None,
    earlier: str | None = None,
) -> DataFrame:
    """One run over detail pages ``(source, url, job_id, html, crawled_at)``.

    Pages may carry a ``batch_no``; without one the URLs that are left after the
    filters go into batches of their site's size. ``checks`` are URL check results with a ``source``; ``urls`` a
    URL map that limits the run to its pages. Returns the saved records. The same
    function serves a batch run and the micro-batches of a stream.

    ``run_id`` names the run: another attempt under the same name saves the same
    rows, once. Without one, what an earlier run over the same sources had claimed but not saved is saved first.

    Runs may share a store. Each settles on its own; one that finds that a run which claimed
    meanwhile is to save an id of its own settles again, with that run's keys as known ones.
    """
    spark, names = pages.sparkSession, [s.name for s in specs]
    turns = areas.turns(spark, store)
    if run_id is None:
        prefix = f"run-{'+'.join(sorted(names))}-"
        for left in areas.pending_runs(spark, store, prefix):
            if turns.is_abandoned(left, options.lease):
                save_claimed(spark, specs, store, left, turns.again(left), options)
        run_id = f"{prefix}{uuid.uuid4().hex}"
    while not areas.is_committed(spark, store, run_id):
        listed = turns.listed()
        base, claimed = (listed[-1].number if listed else 0), set(turns.unsaved(listed).values())
        if run_id in claimed:  # an earlier attempt
            number = turns.again(run_id)
        else:
            staged = settle(pages, specs, store, options, checks, urls, as_of, run_id, sorted(claimed))
            own = areas.write_claim(staged, store, run_id)
            number = turns.claim(run_id, base, lambda others: _shares_ids(own, others, specs, store))
        if number is not None:
            save_claimed(spark, specs, store, run_id, number, options, earlier)
    return areas.read_run(spark, store, names, run_id)


def _shares_ids(own: DataFrame, others: list[str], specs: tuple[SourceSpec, ...], store: Store) -> bool:
    theirs = areas.read_claims(own.sparkSession, store, others).where(of_sources(specs)).select("job_id")
    return not own.select("job_id").join(theirs, "job_id", "left_semi").isEmpty()


def save_claimed(
    spark: SparkSession, specs: tuple[SourceSpec, ...], store: Store, run_id: str, number: int,
    options: IngestOptions = IngestOptions(), earlier: str | None = None,
) -> None:
    """Save a run's staged rows when its turn comes, unless another attempt did."""
    turns = areas.turns(spark, store)
    try:
        turns.wait(number, options.lease)
        if not areas.is_committed(spark, store, run_id):
            staged = areas.staged_facts(spark, store, run_id)
            save(areas.staged_run(spark, store, run_id), specs, store, run_id, staged)
            areas.write_progress(spark, store, run_id, number, staged.rows)
            areas.commit_run(spark, store, run_id, earlier)
    except BaseException:
        turns.fail(number)
        raise
    areas.end_turns(spark, store, run_id)


def settle(
    pages: DataFrame, specs: tuple[SourceSpec, ...], store: Store, options: IngestOptions,
    checks: DataFrame | None, urls: DataFrame | None, as_of: Column | None, run_id: str, claimed: list[str] | None = None,
) -> DataFrame:
    """Decide about every page of a run and stage the records to save.

    Pages are read once for their narrow columns and once, those no filter stops, for
    their HTML. Records are written once; what becomes of them is decided on narrow
    columns, and the decision joined back once. Outcomes of all pages and
    the gate's report go to their areas.
    """
    spark = pages.sparkSession
    pages = pages.where(of_sources(specs))
    keys, n_keys = counted(silver_keys(spark, store, specs, as_of, claimed=claimed), "keys")
    filters = []
    if urls is not None:
        filters.append(Filter.of(urls, ("source", "url"), NOT_LISTED, keep_held=True))
    if options.mode == "id":
        filters.append(Filter(keys.select("job_id").distinct(), ("job_id",), KNOWN_ID, False, n_keys))
    elif options.mode != "id_date":
        raise ValueError(f"unknown mode: {options.mode}")
    if checks is not None:
        log_failed_urls(checks, specs, store, run_id)
        filters.append(Filter.of(failed_urls(checks, specs), ("source", "url"), URL_FAILED))

    given = "batch_no" in pages.columns
    columns = ["source", "url", "job_id", "crawled_at", *(["batch_no"] if given else [])]
    flagged = filtered(pages.select(*columns), filters, options.broadcast_rows)
    flagged = materialize(flagged if given else flagged.withColumn("batch_no", F.lit(None).cast("bigint")), "pages")
    if not given:
        batches = materialize(site_batches(flagged.where(F.col("early").isNull()), specs), "batches")

    # pages that no filter stops; false hits of filters too large to broadcast are settled on the records
    small = [f for f in filters if f.count <= options.broadcast_rows]
    wanted = filtered(pages, small, options.broadcast_rows).where(F.col("early").isNull()).drop("early")
    large = []
    for f in filters:
        if f.count > options.broadcast_rows:
            wanted, settled = f.narrowed(wanted, options)
            large += [] if settled else [f]
    records = detail.extract_details(wanted, specs).withColumns(
        {"key_date": or_empty(key_date(F.col("posted_date"))), "_row": F.monotonically_increasing_id()}
    )
    records_path = shared_dir(spark, "records")
    records = write_table(records, records_path)
    bad = per_source(specs, lambda s: quality.is_bad(s.critical_fields))
    narrow = records.select(
        "_row", "source", "url", "job_id", "key_date", "crawled_at", "page_reject", "title", bad.alias("bad"),
        *(["batch_no"] if given else []),
    )
    narrow = filtered(narrow, large, options.broadcast_rows).where(F.col("early").isNull()).drop("early")
    narrow = incremental.triage(narrow, keys, ["url"], options.known_join(n_keys))
    if not given:
        narrow = narrow.join(batches, ["source", "url"])
    narrow = materialize(narrow, "triage")

    decided, report = gate(narrow, specs)
    failures = areas.write_report(report, store, run_id)
    if options.on_gate == "raise":
        quality.enforce(report, failures)
    stopped = flagged.where(F.col("early").isNotNull()).withColumnsRenamed({"early": "outcome"})
    columns = ["source", "url", "job_id", "batch_no", "outcome", "_row"]
    outcomes = decided.select(*columns).unionByName(stopped.withColumn("_row", F.lit(None).cast("bigint")).select(*columns))
    decided = areas.write_area(outcomes.withColumn("run_id", F.lit(run_id)), store.outcomes, run_id)
    accepted = decided.where((F.col("outcome") == SAVED) & F.col("_row").isNotNull()).select("_row")
    # whole records are moved only when the accepted ones are too many to broadcast
    saved = options.join(records, accepted, ["_row"], "left_semi", ["_row"]).drop("_row", "page_reject", "batch_no")
    staged = areas.stage_run(saved, store, run_id, [s.name for s in specs])
    areas.drop(spark, records_path)
    return staged


def gate(rows: DataFrame, specs: tuple[SourceSpec, ...]) -> tuple[DataFrame, DataFrame]:
    """The outcome of triaged rows ``(source, batch_no, job_id, key_date, bad, reject_reason)``
    when batches are saved in order, and the gate's report of every batch."""
    at, key = ["source", "batch_no"], F.struct("job_id", "key_date")
    open_rows = rows.where(F.col("reject_reason").isNull())
    members = open_rows.groupBy(*at, key.alias("key")).agg(
        F.count(F.lit(1)).alias("total"), F.count_if("bad").alias("bad")
    )
    verdicts, known = incremental.settle_batches(members, per_source(specs, lambda s: F.lit(s.threshold)))
    fields = per_source(specs, lambda s: F.lit(", ".join(s.critical_fields)))
    report = quality.judged(verdicts.select(*at, "total", "bad"), at, fields, per_source(specs, lambda s: F.lit(s.threshold)))
    known = known.withColumn("_known", F.lit(True))
    judged = rows.withColumn("key", key).join(known, [*at, "key"], "left").join(verdicts.select(*at, "passed"), at, "left")
    outcome = (
        F.when(F.col("reject_reason").isNotNull(), F.col("reject_reason"))
        .when(F.col("_known"), F.lit(REPEATED))
        .when(~F.col("passed"), F.lit(GATE_FAILED))
        .otherwise(F.lit(SAVED))
    )
    return judged.withColumn("outcome", outcome).drop("key", "_known", "passed"), report


def log_failed_urls(checks: DataFrame, specs: tuple[SourceSpec, ...], store: Store, run_id: str | None = None) -> None:
    """Failed checks of the sources that check URLs, to the error area."""
    _, failures = url_checks.partition_urls(checks)
    mine = failures.where(F.col("source").isin(*[s.name for s in specs if s.check_urls]))
    areas.append_errors(url_checks.error_records(mine, F.col("source")), store, run_id)


def error_class(specs: tuple[SourceSpec, ...]) -> Column:
    """The class of an error record by its source's markers; a run over several
    sources names them all, and any of their markers counts."""
    rules = [
        F.when(F.array_contains(F.split("source", ","), s.name), url_checks.error_class(F.col("error_msg"), s.disconnect_markers))
        for s in specs
    ]
    return reduce(lambda a, b: F.when((a == "disconnect") | b.isNull(), a).otherwise(b), rules)


def run(
    pages: DataFrame,
    specs: tuple[SourceSpec, ...],
    store: Store,
    listing_pages: DataFrame | None = None,
    max_pages: int = 0,
    **kwargs,
) -> DataFrame:
    """``ingest``, of the jobs that listing pages lead to when there are any.

    A failure is recorded in the error area before it is raised.
    """
    try:
        if listing_pages is not None:
            kwargs["urls"] = crawl_frontier(listing_pages, specs, max_pages)
        return ingest(pages, specs, store, **kwargs)
    except Exception as error:
        names = ",".join(s.name for s in specs)
        areas.append_errors(url_checks.exception_record(pages.sparkSession, error, names, "main"), store)
        raise
