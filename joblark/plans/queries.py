"""The registered queries: every operator over whole tables.

Each query has the SQL in ``oracles.py`` that gives the same rows.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from joblark.functions import dates, html, text
from joblark.functions.elements import with_elements
from joblark.functions.html import Selector
from joblark.operators import detail, incremental, listing, membership, quality, url_checks
from joblark.plans import ingest as jobs
from joblark.plans import site_pages
from joblark.schemas import BRONZE
from joblark.session import fill_cores, materialize, shared_dir
from joblark.sources import archive
from joblark.sources import store as areas
from joblark.sources.sites import DISCONNECT_MARKERS, ITVIEC, SITES, TOPDEV, link_slugs
from joblark.sources.store import Store
from joblark.streaming.ingest_stream import page_stream, start_ingest
from joblark.streaming.new_pairs import start_new_pairs

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _REGISTRY[fn.__name__] = fn
    return fn


def registry() -> dict[str, Query]:
    return dict(_REGISTRY)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _spread(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    return fill_cores(table(spark, sf_dir, name), key)


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spread(spark, sf_dir, "pages", "page_id")


def _day(ts: str) -> Column:
    return F.lit(ts).cast("timestamp_ntz")


def _event_id_text() -> Column:
    return F.concat_ws("-", F.col("user_id").cast("string"), F.col("event_type"))


# ---- fetched pages -----------------------------------------------------------------


@query
def page_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First heading of each raw page."""
    return with_elements(_pages(spark, sf_dir), ["page_id"], title=lambda p: html.text(html.first(p, Selector("h1"))))


@query
def page_slugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last piece of each local link, the first mention per page only."""
    found = with_elements(_pages(spark, sf_dir), ["page_id"], slugs=lambda p: link_slugs(p, "/"))
    return found.select("page_id", F.posexplode("slugs").alias("pos", "slug"))


@query
def page_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text of a container with nested markup, line by line."""
    return with_elements(_pages(spark, sf_dir), ["page_id"], body=lambda p: html.text(html.first(p, Selector("article")), "\n"))


@query
def page_footers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Footer text, which holds named character references."""
    return with_elements(_pages(spark, sf_dir), ["page_id"], footer=lambda p: html.text(html.first(p, Selector("footer"))))


@query
def challenge_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages that are no content. The tables hold no real challenge page, so a
    text that some pages hold stands in beside the site's own markers."""
    markers = (*TOPDEV.challenge_markers, "track(1")
    rows = table(spark, sf_dir, "pages")
    return rows.where(text.contains_any(F.col("html"), markers)).select("page_id", "url")


@query
def headed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw pages and rendered site-1 pages per presence of a heading."""
    raw = _pages(spark, sf_dir).select(F.lit("pages").alias("kind"), html.cut(F.col("html")).alias("html"))
    rendered = site_pages.itviec_pages(_spread(spark, sf_dir, "documents", "doc_id")).select(
        F.lit("itviec").alias("kind"), html.cut(F.col("html")).alias("html")
    )
    both = raw.unionByName(rendered)
    return both.groupBy("kind", detail.has_heading(F.col("html")).alias("headed")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query
def url_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URL without its query, its last piece, and the number that ends it."""
    plain = text.before(text.before(F.col("url"), "?"), "#")
    last = text.after_last(F.btrim(plain, F.lit("/")), "/")
    return table(spark, sf_dir, "pages").select(
        "page_id",
        plain.alias("plain"),
        last.alias("last_piece"),
        text.all_digits(last).alias("is_number"),
        F.regexp_extract(plain, "([0-9]+)/?$", 1).alias("number"),
        text.without_prefix(F.col("url"), "https://").alias("rest"),
    )


# ---- listing -----------------------------------------------------------------------


def _listing_facts(spark: SparkSession, sf_dir: str, *specs) -> DataFrame:
    pages = site_pages.listing_pages(table(spark, sf_dir, "part"))
    return listing.listing_facts(pages, specs)


@query
def listing_slugs_attribute(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = _listing_facts(spark, sf_dir, ITVIEC)
    return facts.select("page_no", F.posexplode("slugs").alias("pos", "slug"))


@query
def listing_slugs_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = _listing_facts(spark, sf_dir, TOPDEV)
    return facts.select("page_no", F.posexplode("slugs").alias("pos", "slug"))


@query
def listing_page_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page count by the rule of each site, here for every listing page."""
    pages = site_pages.listing_pages(table(spark, sf_dir, "part"))
    counts = [with_elements(pages.where(F.col("source") == s.name), ["source", "page_no"], pages=s.page_count) for s in SITES]
    return listing.union_all(counts)


@query
def frontier(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = materialize(_listing_facts(spark, sf_dir, *SITES), "facts")
    return listing.frontier(facts)


@query
def frontier_first_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The frontier of a run limited to three listing pages."""
    facts = materialize(_listing_facts(spark, sf_dir, *SITES), "facts")
    return listing.frontier(facts, max_pages=3)


@query
def url_id_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.crawl_frontier(site_pages.listing_pages(table(spark, sf_dir, "part")), SITES)


@query
def job_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Site-2 ids of page addresses: the number that ends a slug, else the slug."""
    slug = F.concat_ws("-", text.after_last(text.before(F.col("url"), "?"), "//"), F.col("page_id").cast("string"))
    mixed = F.when(F.col("page_id") % 3 == 0, F.concat(slug, F.lit("x"))).otherwise(slug)
    return table(spark, sf_dir, "pages").select("page_id", TOPDEV.job_id(mixed).alias("job_id"))


# ---- detail ------------------------------------------------------------------------


def _itviec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_pages.itviec_pages(_spread(spark, sf_dir, "documents", "doc_id"))


def _topdev(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_pages.topdev_pages(_spread(spark, sf_dir, "conversations", "conv_id"))


def _flat_record(records: DataFrame) -> DataFrame:
    return records.withColumn("skills", F.array_join("skills", "|"))


@query
def itviec_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Site-1 records; pages without a heading give none."""
    records = materialize(detail.extract_details(_itviec(spark, sf_dir), ITVIEC), "itviec")
    return _flat_record(records.where(F.col("page_reject").isNull()).drop("page_reject"))


@query
def archived_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Site-1 records of pages that come from archives, read in byte ranges."""
    folder = f"{shared_dir(spark, 'archive')}/pages"
    archive.append_archive(_itviec(spark, sf_dir), folder)
    records = materialize(detail.extract_details(archive.read_archive(spark, folder), ITVIEC), "archived")
    return _flat_record(records.where(F.col("page_reject").isNull()).drop("page_reject"))


@query
def topdev_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Site-2 records; challenge pages give none."""
    records = materialize(detail.extract_details(_topdev(spark, sf_dir), TOPDEV), "topdev")
    return _flat_record(records.where(F.col("page_reject").isNull()).drop("page_reject", "working_method"))


# ---- scalar functions --------------------------------------------------------------


@query
def relative_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every unit word, and texts that have to pass through."""
    words = [w for w, _ in dates.UNIT_SECONDS]
    phrases = [f" {w}s ago" for w in words] + [f"\xa0{w.upper()} trước" for w in words] + ["", " moons ago", "+ days ago"]
    pick = F.element_at(
        F.array(*[F.lit(p) for p in phrases]), (F.col("l_orderkey") % len(phrases) + 1).cast("int")
    )
    phrase = F.concat(F.lit("Posted "), F.col("l_quantity").cast("int").cast("string"), pick)
    rows = _spread(spark, sf_dir, "lineitem", "l_orderkey").select(
        "l_orderkey", "l_linenumber", phrase.alias("phrase"), dates.ntz_as_utc(F.col("l_shipdate")).alias("at")
    )
    posted = dates.relative_date(F.col("phrase"), F.col("at"))
    return rows.select("l_orderkey", "l_linenumber", "phrase", posted.alias("posted_date"))


@query
def dmy_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    day, month, year = (f(F.col("o_orderdate")).cast("string") for f in (F.day, F.month, F.year))
    key = F.col("o_orderkey")
    mark = F.when(key % 2 == 0, "/").otherwise("-")
    phrase = F.when(key % 7 == 0, F.lit(" \topen ")).otherwise(
        F.concat(F.lit("Deadline: "), day, mark, month, mark, year, F.lit(" or 1/1/1999"))
    )
    return _spread(spark, sf_dir, "orders", "o_orderkey").select("o_orderkey", dates.dmy_date(phrase).alias("posted_date"))


@query
def key_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw dates as key text; half of the days do not exist in the calendar."""
    number = F.col("o_orderkey") % 62 + 1
    raw = F.concat(F.date_format("o_orderdate", "yyyy-MM-"), text.pad2(number.cast("string")))
    shown = F.when(F.col("o_orderkey") % 9 == 0, F.lit("yesterday")).otherwise(raw)
    return _spread(spark, sf_dir, "orders", "o_orderkey").select("o_orderkey", dates.key_date(shown).alias("key_date"))


@query
def stripped_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = F.concat(F.lit(" \t\u2003\xa0"), F.col("text"), F.lit("\n\u3000\x1f "))
    blank = F.when(F.col("doc_id") % 10 == 0, F.lit("\xa0\t")).otherwise(padded)
    return table(spark, sf_dir, "documents").select(
        "doc_id", text.strip(blank).alias("stripped"), text.is_blank(blank).alias("blank")
    )


@query
def decoded_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Character references of every form, around whole texts."""
    shown = F.concat(F.lit("&eacute;&#8364;&#x1F600;&lt;b&gt; "), site_pages.escape(F.col("text")), F.lit(" &unknown; & &#128;"))
    return _spread(spark, sf_dir, "documents", "doc_id").select("doc_id", text.unescape(shown).alias("decoded"))


@query
def iso_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = dates.ntz_as_utc(F.col("ts"))
    return table(spark, sf_dir, "events").select("event_id", text.utc_iso(at).alias("crawled_at"))


@query
def record_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON object per record, non-ASCII text kept."""
    cells = F.struct(
        F.col("doc_id").cast("string").alias("job_id"),
        site_pages.title_of(F.col("text")).alias("title"),
        F.array("lang", "source").alias("skills"),
        F.col("text").alias("description"),
        F.when(F.col("doc_id") % 5 != 0, F.col("source")).alias("source"),
    )
    line = F.to_json(cells, {"ignoreNullFields": "false"})
    return table(spark, sf_dir, "documents").select("doc_id", line.alias("line"))


# ---- incremental load --------------------------------------------------------------


def _silver_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a fact table, with some null ids and dates."""
    number = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.when(number % 50 != 0, _event_id_text()).alias("job_id"),
        F.when(number % 20 != 0, F.to_date("ts")).alias("posted_date"),
        F.col("ts").alias("crawled_at"),
        "value",
    )


@query
def recent_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _silver_events(spark, sf_dir)
    return incremental.recent_keys(rows, as_of=F.lit("2024-02-10").cast("date"))


def _known_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of one week; all events are candidates."""
    rows = _silver_events(spark, sf_dir).where(F.col("crawled_at") < _day("2024-01-23"))
    return incremental.recent_keys(rows, as_of=F.lit("2024-01-23").cast("date"), days=7)


def _candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", _event_id_text().alias("job_id"), "ts")


@query
def new_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    fresh = incremental.new_ids(_candidates(spark, sf_dir), _known_events(spark, sf_dir), ["event_id"])
    return fresh.select("event_id", "job_id")


@query
def filtered_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with known ids that count as too many to broadcast: a filter over them, its false hits settled."""
    rows, keys = _candidates(spark, sf_dir), materialize(_known_events(spark, sf_dir).select("job_id").distinct(), "known")
    count = keys.count()
    fresh = membership.without_members(rows, keys, ("job_id",), count, count // 2, ["event_id"])
    if fresh is None:
        fresh = incremental.new_ids(rows, keys, ["event_id"])
    return fresh.select("event_id", "job_id")


@query
def first_run_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without a silver table nothing is known and every candidate is new."""
    keys = incremental.known_keys(spark, "no_such_schema.fact_jobs")
    return incremental.new_ids(_candidates(spark, sf_dir), keys, ["event_id"]).select("job_id").distinct()


@query
def new_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of id and posted date; an absent date is a date of its own."""
    rows = _candidates(spark, sf_dir).select(
        "event_id",
        "job_id",
        F.when(F.col("event_id") % 10 != 0, F.date_format(F.col("ts") - F.expr("INTERVAL 7 DAYS"), "yyyy-MM-dd"))
        .alias("posted_date"),
    )
    return incremental.new_records(rows, _known_events(spark, sf_dir), ["event_id"])


@query
def skipped_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental.skipped_count(_candidates(spark, sf_dir), _known_events(spark, sf_dir))


@query
def dedup_across_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", F.expr("event_id div 500").alias("batch_no")
    )
    kept = incremental.dedup_across_batches(rows, ["event_id"], ["user_id", "event_type"])
    return kept.select("event_id", "user_id", "event_type", "batch_no")


@query
def micro_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in batches of five, per source."""
    urls = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("source"), F.col("event_id").cast("string").alias("url")
    )
    return incremental.assign_batches(urls, F.lit(5)).select("source", "url", "batch_no")


@query
def batch_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batches that the job makes of both sites' pages."""
    return jobs.site_batches(_job_pages(spark, sf_dir), SITES).select("source", "url", "batch_no")


@query
def keys_of_failed_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as records of batches, every other of which fails: what it holds is not known to later ones."""
    rows = table(spark, sf_dir, "events").select(
        "event_id",
        F.lit(ITVIEC.name).alias("source"),
        (F.expr("event_id div 50") + 1).alias("batch_no"),
        _event_id_text().alias("job_id"),
        F.lit("").alias("key_date"),
        (F.expr("event_id div 50") % 2 == 0).alias("bad"),
        F.when(F.col("event_id") % 17 == 0, F.lit("no_title")).alias("reject_reason"),
    )
    decided, _ = jobs.gate(rows, (ITVIEC,))
    return decided.select("event_id", "batch_no", "outcome")


@query
def new_url_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The URL map of the ids that are new; every third part is known."""
    part = table(spark, sf_dir, "part")
    slugs = part.select(F.lit(ITVIEC.name).alias("source"), F.concat_ws("-", F.lit("part"), F.col("p_partkey").cast("string")).alias("slug"))
    keys = part.where(F.col("p_partkey") % 3 == 0).select(
        F.concat(F.lit("itviec_part-"), F.col("p_partkey").cast("string")).alias("job_id")
    )
    return incremental.new_ids(listing.url_id_map(slugs, (ITVIEC,)), keys, ["url"]).select("url", "job_id")


def _known_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key pairs of every fifth conversation, the dates of every tenth differ."""
    key, turn = F.col("conv_id"), F.col("turn")
    date = F.concat_ws("-", F.lit("2024"), text.pad2((key % 12 + 1).cast("string")),
                       text.pad2((key % 28 + 1).cast("string")))
    return table(spark, sf_dir, "conversations").where(key % 5 == 0).select(
        F.concat(F.lit("topdev_"), (key * 1000 + turn).cast("string")).alias("job_id"),
        F.when(key % 10 == 0, F.lit("2023-12-31")).otherwise(date).alias("posted_date"),
    )


@query
def triage(spark: SparkSession, sf_dir: str) -> DataFrame:
    options = jobs.IngestOptions(mode="id_date")
    rows = jobs.triaged(_topdev(spark, sf_dir), _known_turns(spark, sf_dir), (TOPDEV,), options)
    return rows.select("job_id", "key_date", "reject_reason")


@query
def run_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("source"),
        (F.expr("event_id div 50") + 1).alias("batch_no"),
        (F.col("value") > 10).alias("saved"),
    )
    return incremental.run_progress(rows, block=64)


# ---- quality -----------------------------------------------------------------------


def _graded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as records with blank fields here and there, in ten batches."""
    number = F.col("doc_id")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.col("lang").alias("source"),
        (number % 10).alias("batch_no"),
        F.when(number % 4 == 0, F.lit("\t ")).otherwise(site_pages.title_of(F.col("text"))).alias("title"),
        F.when(F.col("n_chars") < 600, F.lit(None)).otherwise(F.col("source")).alias("company"),
    )


@query
def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Short or blank texts per language, against a threshold."""
    rows = table(spark, sf_dir, "documents")
    bad = text.is_blank(F.col("text")) | (F.col("n_chars") < 200)
    return quality.quality_report(rows, ["lang"], ("text",), bad=bad)


@query
def quality_report_by_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(_graded(spark, sf_dir), ["source", "batch_no"])


@query
def quality_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of the groups that pass the gate."""
    rows, by = _graded(spark, sf_dir), ["source", "batch_no"]
    report = quality.quality_report(rows, by)
    return quality.passing_records(rows, report, by, ["doc_id"]).select("doc_id", *by)


# ---- URL checks and errors ---------------------------------------------------------


def _fetch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as probe answers of every class."""
    codes = [200, 204, 304, 404, 410, 451, 429, 500, 502, 503, 504, 403, 0]
    number = F.col("o_orderkey")
    code = F.element_at(F.array(*[F.lit(c) for c in codes]), (number % len(codes) + 1).cast("int"))
    return table(spark, sf_dir, "orders").select(
        F.when(number % 2 == 0, ITVIEC.name).otherwise(TOPDEV.name).alias("source"),
        F.concat(F.lit("https://jobs.example/"), number.cast("string")).alias("url"),
        F.nullif(code, F.lit(0)).alias("status_code"),
        F.col("o_orderpriority").alias("reason"),
        F.when((number % 26 == 12), "TimeoutError").otherwise("").alias("error_type"),
        F.when(code != 200, F.lit("Traceback\nline")).alias("tb_str"),
    )


@query
def checked_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = url_checks.check_urls(_fetch_log(spark, sf_dir))
    return checks.select("url", "is_valid", "status_code", "reason", "error_type", "tb_str")


@query
def url_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts per side, code, severity and failure class."""
    checks = url_checks.check_urls(_fetch_log(spark, sf_dir))
    valid, failed = url_checks.partition_urls(checks)
    code = F.col("status_code")
    good = valid.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("valid").alias("side"), F.lit(-1).alias("status_code"), F.lit("").alias("severity"),
        F.lit("").alias("failure_class"), "n")
    bad = failed.groupBy(
        F.lit("failed").alias("side"), code.alias("status_code"), url_checks.severity(code).alias("severity"),
        url_checks.failure_class(code).alias("failure_class"),
    ).agg(F.count(F.lit(1)).alias("n"))
    return good.unionByName(bad)


@query
def url_check_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_checks.check_counts(url_checks.check_urls(_fetch_log(spark, sf_dir)))


@query
def url_check_switch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source that does not check URLs keeps them all."""
    log = _fetch_log(spark, sf_dir)
    parts = []
    for spec in SITES:
        own = log.where(F.col("source") == spec.name)
        checks = url_checks.check_urls(own) if spec.check_urls else url_checks.all_valid(own)
        valid, _ = url_checks.partition_urls(checks)
        parts.append(valid.select(F.lit(spec.name).alias("source"), "url"))
    return listing.union_all(parts)


def _errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, failed = url_checks.partition_urls(url_checks.check_urls(_fetch_log(spark, sf_dir)))
    return url_checks.error_records(failed, F.col("source"))


@query
def error_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _errors(spark, sf_dir).drop("timestamp")


@query
def error_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error records written as JSONL in two appends and read back."""
    store = Store(shared_dir(spark, "errors"))
    errors = _errors(spark, sf_dir)
    areas.append_errors(errors.where(F.col("source") == ITVIEC.name), store)
    areas.append_errors(errors.where(F.col("source") == TOPDEV.name), store)
    return areas.read_errors(spark, store).drop("timestamp")


@query
def error_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error texts by class; some texts name a lost connection."""
    number = F.col("doc_id")
    message = F.when(number % 6 == 0, F.concat(F.lit("WebSocket error: "), F.col("text"))).when(
        number % 10 == 1, F.concat(F.col("text"), F.lit(" Connection CLOSED while reading"))
    ).otherwise(F.col("text"))
    return table(spark, sf_dir, "documents").select(
        "doc_id", url_checks.error_class(message, DISCONNECT_MARKERS).alias("error_class")
    )


# ---- sinks and whole jobs ----------------------------------------------------------


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw records straight from documents."""
    number = F.col("doc_id")
    return table(spark, sf_dir, "documents").select(
        F.concat(F.lit("itviec_"), number.cast("string")).alias("job_id"),
        site_pages.title_of(F.col("text")).alias("title"),
        F.col("source").alias("company"),
        F.lit("").alias("salary"),
        F.col("lang").alias("locations"),
        F.when(number % 2 == 0, "Hybrid").alias("working_method"),
        F.when(number % 3 == 0, "30+ days ago").otherwise(F.concat(F.lit("2024-02-"), text.pad2((number % 40).cast("string")))).alias("posted_date"),
        F.array("lang", "source").alias("skills"),
        F.col("text").alias("description"),
        F.lit(ITVIEC.name).alias("source"),
        F.concat(F.lit("https://jobs.example/"), number.cast("string")).alias("url"),
        text.utc_iso(site_pages.seen_at(number)).alias("crawled_at"),
    )


@query
def jsonl_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records appended in two runs and read back whole."""
    store = Store(shared_dir(spark, "jsonl"))
    rows = _records(spark, sf_dir)
    areas.append_jobs(rows.where("locations = 'en'"), store, ITVIEC.name)
    areas.append_jobs(rows.where("locations <> 'en'"), store, ITVIEC.name)
    areas.append_jobs(rows.where("locations = 'none'"), store, ITVIEC.name)
    return _flat_record(areas.read_jobs(spark, store, ITVIEC.name))


@query
def jsonl_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second write replaces the first, an empty third one does not."""
    path = shared_dir(spark, "overwrite")
    rows = _records(spark, sf_dir)
    areas.overwrite_jobs(rows, path)
    areas.overwrite_jobs(rows.where("working_method = 'Hybrid'"), path)
    areas.overwrite_jobs(rows.where("working_method = 'none'"), path)
    return spark.read.schema(BRONZE).json(path).select("job_id", "working_method", "description")


@query
def silver_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set-up, then the same records loaded twice: typed rows, each once."""
    store = Store(shared_dir(spark, "silver"))
    areas.ensure_fact_table(spark, store)
    rows = _records(spark, sf_dir)
    areas.load_silver(rows, store)
    areas.load_silver(rows, store)
    areas.ensure_fact_table(spark, store)
    silver = areas.read_silver(spark, store)
    return _flat_record(silver).select(
        "job_id", "title", "company", "salary", "locations", "working_method",
        F.col("posted_date").cast("string").alias("posted_date"), "skills", "source", "url",
        F.unix_seconds("crawled_at").alias("crawled_seconds"),
        F.col("ingested_at").isNotNull().alias("ingested"),
    )


_SAVED = ("job_id", "title", "company", "posted_date", "url")


def _store_with_silver(spark: SparkSession, sf_dir: str, name: str) -> Store:
    """A store whose silver table knows every ninth document already."""
    store = Store(shared_dir(spark, name))
    areas.ensure_fact_table(spark, store)
    known = _records(spark, sf_dir).withColumn("job_id", F.replace("job_id", F.lit("itviec_"), F.lit("itviec_role-")))
    number = F.substring_index("job_id", "-", -1).cast("bigint")
    areas.load_silver(known.where(number % 9 == 0), store)
    return store


def _job_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _itviec(spark, sf_dir).unionByName(_topdev(spark, sf_dir))


def _as_of() -> Column:
    return F.lit("2024-01-05").cast("date")


@query
def batch_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job on both sites: known ids, extraction, triage, gate per batch, sinks."""
    store = _store_with_silver(spark, sf_dir, "batch")
    number = F.regexp_extract("url", "-([0-9]+)$", 1).cast("bigint")
    pages = _job_pages(spark, sf_dir).withColumn("batch_no", number % 7)
    jobs.run(pages, SITES, store, options=jobs.IngestOptions(on_gate="reject"), as_of=_as_of())
    saved = listing.union_all([areas.read_jobs(spark, store, s.name) for s in SITES])
    return saved.select(*_SAVED)


@query
def listed_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job from its listing pages on: only pages that the frontier names, in batches of the site's size."""
    store = _store_with_silver(spark, sf_dir, "listed")
    listed = site_pages.listing_pages(table(spark, sf_dir, "documents"), "doc_id", "role-")
    details = _itviec(spark, sf_dir)
    jobs.run(details, (ITVIEC,), store, listing_pages=listed, options=_REJECT, as_of=_as_of())
    return areas.read_jobs(spark, store, ITVIEC.name).select(*_SAVED)


_REJECT = jobs.IngestOptions(on_gate="reject")


def _checked_run(spark: SparkSession, sf_dir: str, name: str) -> Store:
    """The job with URL checks of the source that has them."""
    store = Store(shared_dir(spark, name))
    pages = _job_pages(spark, sf_dir)
    number = F.regexp_extract("url", "-([0-9]+)$", 1).cast("bigint")
    log = pages.select(
        "source", "url", F.when(number % 8 == 3, 404).otherwise(200).alias("status_code"),
        F.lit("Not Found").alias("reason"), F.lit("").alias("error_type"), F.lit("").alias("tb_str"),
    )
    jobs.run(pages, SITES, store, options=_REJECT, checks=url_checks.check_urls(log), as_of=_as_of())
    return store


@query
def checked_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _checked_run(spark, sf_dir, "checked")
    saved = areas.read_silver(spark, store).groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    errors = areas.read_errors(spark, store).groupBy(F.lit("error").alias("source")).agg(F.count(F.lit(1)).alias("n"))
    return saved.unionByName(errors)


@query
def page_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What became of every page of a run: saved, or one reason why not."""
    store = _checked_run(spark, sf_dir, "outcomes")
    return areas.read_outcomes(spark, store).groupBy("source", "outcome").agg(F.count(F.lit(1)).alias("n"))


@query
def gate_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gate's report of every batch of a run."""
    store = _checked_run(spark, sf_dir, "reports")
    return areas.read_reports(spark, store).select("source", "batch_no", "total", "bad", "passed", "message")


@query
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One stream a site over page files, both on one store, known rows included."""
    store = _store_with_silver(spark, sf_dir, "stream")
    for spec, pages in ((ITVIEC, _itviec(spark, sf_dir)), (TOPDEV, _topdev(spark, sf_dir))):
        inbox = f"{store.base}/inbox/{spec.name}"
        pages.write.parquet(inbox)
        start_ingest(page_stream(spark, inbox), (spec,), store, f"{store.base}/checkpoint/{spec.name}").awaitTermination()
    saved = listing.union_all([areas.read_jobs(spark, store, s.name) for s in SITES])
    return saved.select(*_SAVED)


@query
def saved_so_far(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream that is started again whenever more pages have come: what its micro-batches saved, and all until each."""
    store = Store(shared_dir(spark, "progress"))
    areas.ensure_fact_table(spark, store)
    inbox, number = f"{store.base}/inbox", F.regexp_extract("url", "-([0-9]+)$", 1).cast("bigint")
    for part in range(3):
        _topdev(spark, sf_dir).where(number % 3 == part).write.mode("append").parquet(inbox)
        found = page_stream(spark, inbox, files_per_batch=1_000_000)
        start_ingest(found, (TOPDEV,), store, f"{store.base}/checkpoint").awaitTermination()
    return incremental.batch_progress(areas.read_progress(spark, store).withColumnRenamed("turn", "batch_no"))


@query
def concurrent_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs at once over two thirds of the pages each: what both have is saved by one of them."""
    store = Store(shared_dir(spark, "concurrent"))
    areas.ensure_fact_table(spark, store)
    number = F.regexp_extract("url", "-([0-9]+)$", 1).cast("bigint")
    pages = _topdev(spark, sf_dir)
    with ThreadPoolExecutor(2) as pool:
        shares = [pages.where(number % 3 != part) for part in (0, 1)]
        list(pool.map(lambda share: jobs.run(share, (TOPDEV,), store, options=_REJECT, as_of=_as_of()), shares))
    return areas.read_jobs(spark, store, TOPDEV.name).select(*_SAVED)


@query
def stream_new_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of three times of a month as a stream of three micro-batches, whose state knows what was kept in the last ten days."""
    base = shared_dir(spark, "pairs")
    day = F.dayofmonth("ts")
    rows = table(spark, sf_dir, "events").select(
        "event_id", _event_id_text().alias("job_id"), F.when(F.col("event_id") % 3 == 0, F.lit("2024-01-01")).alias("posted_date"),
        dates.ntz_as_utc(F.col("ts")).alias("crawled_at"), F.when(day <= 8, 1).when(day <= 16, 2).otherwise(3).alias("batch"),
    )
    inbox = f"{base}/inbox"
    for batch in (1, 2, 3):  # started again whenever more have come, which one micro-batch then takes
        rows.where(F.col("batch") == batch).drop("batch").write.mode("append").parquet(inbox)
        stream = spark.readStream.schema(rows.drop("batch").schema).parquet(inbox)
        start_new_pairs(stream, f"{base}/kept", f"{base}/checkpoint", look_back_days=10).awaitTermination()
    return spark.read.parquet(f"{base}/kept").select("event_id", "job_id", "posted_date")


@query
def streamed_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw pages from archives as a stream, which is started again when more have come."""
    base, rows = shared_dir(spark, "archives"), _pages(spark, sf_dir)
    pages = rows.select(
        F.lit("web").alias("source"), "url", F.col("page_id").cast("string").alias("job_id"), "html", F.lit(None).cast("timestamp").alias("crawled_at")
    )
    for part in (F.col("job_id").cast("long") % 2 == 0, F.col("job_id").cast("long") % 2 == 1):
        archive.append_archive(pages.where(part), f"{base}/pages")
        found = archive.archive_stream(spark, f"{base}/pages")
        found = found.select(F.col("job_id").cast("long").alias("page_id"), "url", F.char_length("html").cast("long").alias("n_chars"), F.md5("html").alias("html_md5"))
        sink = found.writeStream.format("parquet").option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True)
        sink.start(f"{base}/read").awaitTermination()
    return spark.read.parquet(f"{base}/read")


# ---- catalog -----------------------------------------------------------------------


def _catalog_store(spark: SparkSession, name: str) -> Store:
    base = shared_dir(spark, name)
    return Store(base, schema="jobs_" + base.rsplit("-", 1)[-1])


@query
def catalog_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The set-up job, twice, then silver rows through the catalog's fact table."""
    store = _catalog_store(spark, "catalog")
    areas.bootstrap(spark, store)
    areas.load_silver(_records(spark, sf_dir), store)
    areas.bootstrap(spark, store)
    return incremental.known_keys(spark, store.table(areas.FACT_TABLE), as_of=F.lit("2024-01-20").cast("date"))


@query
def catalog_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each area through the catalog: raw records and error records."""
    store = _catalog_store(spark, "areas")
    areas.bootstrap(spark, store)
    areas.append_jobs(_records(spark, sf_dir), store, ITVIEC.name)
    areas.append_errors(_errors(spark, sf_dir), store)
    raw = spark.table(store.table("raws")).groupBy(F.lit("raws").alias("area"), "source").agg(F.count(F.lit(1)).alias("n"))
    errors = spark.table(store.table("error")).groupBy(F.lit("error").alias("area"), "source").agg(F.count(F.lit(1)).alias("n"))
    return raw.unionByName(errors)


@query
def failed_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run without a first listing page fails: its exception as a classed error record, and what it saved."""
    store = Store(shared_dir(spark, "failed"))
    listed = site_pages.listing_pages(table(spark, sf_dir, "documents"), "doc_id", "role-").where("page_no > 1")
    try:
        jobs.run(_itviec(spark, sf_dir), (ITVIEC,), store, listing_pages=listed, options=_REJECT, as_of=_as_of())
    except listing.ListingError:
        pass
    errors = areas.read_errors(spark, store, jobs.error_class(SITES))
    saved = areas.silver_files(spark, store).count()
    return errors.select("source", "error_type", "error_msg", "context", "error_class", F.lit(saved).alias("saved"))
