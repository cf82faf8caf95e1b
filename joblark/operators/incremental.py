"""Incremental load: known keys, new rows, batches and run progress."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from joblark.functions.text import or_empty
from joblark.operators.joins import Join, skew_join
from joblark.schemas import KEYS
from joblark.session import materialize

LOOK_BACK_DAYS = 30
PAIR = ["job_id", "posted_date"]

KNOWN_RECORD = "known_record"
NO_TITLE = "no_title"


# ---- known keys --------------------------------------------------------------------


def recent_keys(table: DataFrame, as_of: Column | None = None, days: int = LOOK_BACK_DAYS) -> DataFrame:
    """Distinct ``(job_id, posted_date)`` texts of rows crawled in the look-back.

    The bound is a plain comparison on ``crawled_at``, so it reaches the scan.
    """
    today = as_of if as_of is not None else F.current_date()
    date = F.col("posted_date")
    return (
        table.where(F.col("crawled_at") >= F.date_sub(today, days))
        .select(
            or_empty(F.col("job_id")).alias("job_id"),
            or_empty(date.cast("string")).alias("posted_date"),
        )
        .where(F.col("job_id") != "")
        .distinct()
    )


def no_keys(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], KEYS)


def known_keys(spark: SparkSession, table: str, as_of: Column | None = None) -> DataFrame:
    """Recent keys of a catalog table; none when the table does not exist yet.

    Any other failure is raised: an empty key set would load everything again.
    """
    if not spark.catalog.tableExists(table):
        return no_keys(spark)
    return recent_keys(spark.read.table(table), as_of)


# ---- new rows ----------------------------------------------------------------------


def new_ids(candidates: DataFrame, keys: DataFrame, spread: list[str], join: Join = skew_join) -> DataFrame:
    """Candidates whose ``job_id`` alone is not known; their other columns stay."""
    return join(candidates, keys.select("job_id").distinct(), ["job_id"], "left_anti", spread)


def new_records(records: DataFrame, keys: DataFrame, spread: list[str], join: Join = skew_join) -> DataFrame:
    """Records whose pair of id and posted date is not known (null dates count as "")."""
    clean = records.withColumns({c: or_empty(F.col(c)) for c in PAIR})
    return join(clean, keys.select(*PAIR).distinct(), PAIR, "left_anti", spread)


def skipped_count(candidates: DataFrame, keys: DataFrame) -> DataFrame:
    """One row: distinct candidate ids, those that are new and those skipped."""
    ids = candidates.select("job_id").distinct()
    known = keys.select("job_id").distinct().withColumn("_known", F.lit(True))
    return ids.join(known, "job_id", "left").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("_known").isNull()).alias("new"),
        F.count_if(F.col("_known").isNotNull()).alias("skipped"),
    )


def dedup_across_batches(
    rows: DataFrame, spread: list[str], keys: list[str] = PAIR, join: Join = skew_join
) -> DataFrame:
    """Keep rows of the first batch that has their key; equal keys inside it all stay.

    No window holds all rows of a key: the first batch of each key is an
    aggregate that combines before the shuffle, and rows are joined with it once.
    Rows with a null in their key all stay.
    """
    firsts = rows.groupBy(*keys).agg(F.min("batch_no").alias("_first"))
    joined = join(rows, firsts, keys, "left", spread)
    return joined.where(F.col("_first").isNull() | (F.col("batch_no") == F.col("_first"))).drop("_first")


# Members of some batches that one task replays in order, a few tens of megabytes.
BLOCK_ROWS = 200_000
WIDEN = 16


def settle_batches(members: DataFrame, threshold: Column, block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, DataFrame]:
    """Which batches pass the gate when they are saved in order, and what repeats in them.

    ``members`` has ``(source, batch_no, key, total, bad)``: records and bad records
    of a key in a batch. A key counts as known in a batch once an earlier batch
    of its source that passed holds it, and its records there are not judged. A batch without records to judge passes.
    Returns ``(source, batch_no, total, bad, passed)`` and the ``(source, batch_no, key)``
    that are known there.

    Only keys of several batches make one batch depend on another. Their batches are replayed in order
    in blocks: neighbouring batches of a source in one sorted group, so that chains inside a block cost no round.
    A batch whose verdict is the same whatever becomes of its pending keys is decided at once, others wait
    for the next round, whose blocks are ``WIDEN`` times as wide as long as what is left in each fits a task.
    So only chains in which every verdict hangs on the one before, and which are longer than a block, take a round a block; every
    round decides at least the first open batch of each source. A batch of more than ``block_rows`` shared keys is
    judged by an aggregation. Counts are taken once, when all verdicts are known.
    """
    at = ["source", "batch_no"]
    members = materialize(members.select(*at, "key", "total", "bad", F.to_json(F.struct("key")).alias("_key")), "members")
    shared = members.groupBy("source", "_key").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    repeats = materialize(members.join(shared, ["source", "_key"], "left_semi"), "repeats")
    whole = members.groupBy(*at).agg(F.sum("total").alias("total"), F.sum("bad").alias("bad"))
    if repeats.isEmpty():
        return materialize(whole.select(*at, "total", "bad", _passes(threshold).alias("passed")), "settled"), repeats.select(*at, "key")
    whole = materialize(whole, "whole")
    sizes = repeats.groupBy(*at).agg(F.count(F.lit(1)).alias("_n"))
    judged = whole.select(*at, F.col("total").alias("all"), F.col("bad").alias("all_bad"), threshold.alias("limit"))
    linked = repeats.drop("key").join(sizes.select(*at, (F.col("_n") > block_rows).alias("large")), at).join(judged, at)
    left, held = materialize(linked, "left"), None
    widest = sizes.where(F.col("_n") <= block_rows).agg(F.max("_n").alias("n")).first()["n"] or block_rows
    width = max(1, block_rows // widest)
    while True:
        verdicts = materialize(_replayed(left, held, width), "verdicts").where(F.col("passed").isNotNull())
        fresh = left.join(verdicts.where("passed").select(*at), at, "left_semi").select("source", "_key", "batch_no")
        if held is not None:
            fresh = fresh.unionByName(held.withColumnRenamed("held", "batch_no"))
        held = materialize(fresh.groupBy("source", "_key").agg(F.min("batch_no").alias("held")), "held")
        left = materialize(left.join(verdicts.select(*at), at, "left_anti"), "left")
        if left.isEmpty():
            break
        wider = left.where(~F.col("large")).groupBy("source", F.floor(F.col("batch_no") / (width * WIDEN)).alias("_block"))
        most = wider.agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("n")).first()["n"] or 0
        if most <= block_rows:
            width *= WIDEN
    known = materialize(repeats.join(held, ["source", "_key"]).where(F.col("held") < F.col("batch_no")).select(*at, "key", "total", "bad"), "known")
    again = known.groupBy(*at).agg(F.sum("total").alias("_total"), F.sum("bad").alias("_bad"))
    none = F.lit(0)
    settled = whole.join(again, at, "left").select(
        *at, (F.col("total") - F.coalesce("_total", none)).alias("total"), (F.col("bad") - F.coalesce("_bad", none)).alias("bad")
    )
    return settled.withColumn("passed", _passes(threshold)), known.select(*at, "key")


def _passes(limit: Column) -> Column:
    return (F.col("total") == 0) | (F.try_divide("bad", "total") <= limit)


def _replayed(left: DataFrame, held: DataFrame | None, width: int) -> DataFrame:
    """``(source, batch_no, passed)`` of the open batches, null where it cannot be told yet;
    ``left`` holds their shared keys, ``held`` the first batch that passed with a key."""
    small, no = ~F.col("large"), F.lit(False)
    firsts = left.groupBy("source", "_key").agg(
        F.min(F.when(small, F.col("batch_no"))).alias("_small"), F.min(F.when(F.col("large"), F.col("batch_no"))).alias("_large")
    )
    state = left.join(firsts, ["source", "_key"])
    state = state.join(held, ["source", "_key"], "left") if held is not None else state.withColumn("held", F.lit(None).cast("bigint"))
    block = lambda c: F.floor(F.col(c) / width)
    # batches of the own block are told apart when it is replayed
    ahead = F.when(small, block("_small") < block("batch_no")).otherwise(F.col("_small") < F.col("batch_no"))
    state = state.withColumn("known", F.coalesce(F.col("held") < F.col("batch_no"), no)).withColumn(
        "pending", ~F.col("known") & (F.coalesce(ahead, no) | F.coalesce(F.col("_large") < F.col("batch_no"), no))
    )
    columns = ["source", "batch_no", "_key", "total", "bad", "all", "all_bad", "limit", "known", "pending"]
    schema = f"source string, batch_no {left.schema['batch_no'].dataType.simpleString()}, passed boolean"
    blocks = state.where(small).select(*columns, block("batch_no").alias("_block")).groupBy("source", "_block")
    over = F.col("bad") - F.col("limit") * F.col("total")
    sums = state.where("large").groupBy("source", "batch_no").agg(
        (F.first("all") - F.sum(F.when(F.col("known"), F.col("total")).otherwise(0))).alias("total"),
        (F.first("all_bad") - F.sum(F.when(F.col("known"), F.col("bad")).otherwise(0))).alias("bad"), F.first("limit").alias("limit"),
        F.sum(F.when(F.col("pending"), F.least(over, F.lit(0.0))).otherwise(0.0)).alias("low"),
        F.sum(F.when(F.col("pending"), F.greatest(over, F.lit(0.0))).otherwise(0.0)).alias("high"), F.max("pending").alias("waits"),
    )
    value, margin = F.col("bad") - F.col("limit") * F.col("total"), _MARGIN * (1 + F.col("total"))
    told = F.when(~F.col("waits"), _passes(F.col("limit"))).when(value - F.col("low") < -margin, True).when(value - F.col("high") > margin, False)
    return blocks.applyInArrow(_replay, schema).unionByName(sums.select("source", "batch_no", told.alias("passed")))


_MARGIN = 1e-9  # a verdict this close to the limit, in records, is only given on exact counts


def _verdict(total: int, bad: int, limit: float, pending: list[float]) -> bool | None:
    """Whether a batch passes whichever of its pending keys turn out to be known; None if that matters.
    ``pending`` has by how much a key's bad records exceed its share of the limit."""
    if not pending:
        return total == 0 or bad / total <= limit
    value, margin = bad - limit * total, _MARGIN * (1 + total)
    if value - sum(w for w in pending if w < 0) < -margin:
        return True
    return False if value - sum(w for w in pending if w > 0) > margin else None


def _replay(block: pa.Table) -> pa.Table:
    """The batches of one block in order, with the keys that passed and those that are undecided."""
    rows = block.sort_by("batch_no")
    number, known, pending, total, bad, whole, whole_bad, limit = (
        rows.column(c).to_numpy().tolist() for c in ("batch_no", "known", "pending", "total", "bad", "all", "all_bad", "limit")
    )
    keys = rows.column("_key").combine_chunks().dictionary_encode().indices.to_numpy().tolist()  # equal keys, equal numbers
    passed_keys: set[int] = set()
    open_keys: set[int] = set()
    first, out = 0, []
    while first < len(number):
        end, left, left_bad, waiting = first, whole[first], whole_bad[first], []
        while end < len(number) and number[end] == number[first]:
            if known[end] or keys[end] in passed_keys:
                left -= total[end]
                left_bad -= bad[end]
            elif pending[end] or keys[end] in open_keys:
                waiting.append(bad[end] - limit[end] * total[end])
            end += 1
        passed = _verdict(left, left_bad, limit[first], waiting)
        if passed is None:
            open_keys.update(keys[first:end])
        elif passed:
            passed_keys.update(keys[first:end])
        out.append((number[first], passed))
        first = end
    source = rows.column("source").slice(0, 1).to_pylist() * len(out)
    columns = [source, [n for n, _ in out], [p for _, p in out]]
    kinds = [pa.string(), block.schema.field("batch_no").type, pa.bool_()]
    return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["source", "batch_no", "passed"])


def triage(records: DataFrame, keys: DataFrame, spread: list[str], join: Join = skew_join) -> DataFrame:
    """All records with a ``reject_reason``, null for those to save.

    Order of reasons: the page gave no content, no title, already known. The
    raw ``posted_date`` is compared through ``key_date``, a key text column.
    """
    known = (
        keys.select("job_id", F.col("posted_date").alias("key_date"))
        .distinct()
        .withColumn("_known", F.lit(True))
    )
    joined = join(records, known, ["job_id", "key_date"], "left", spread)
    reason = (
        F.when(F.col("page_reject").isNotNull(), F.col("page_reject"))
        .when(or_empty(F.col("title")) == "", F.lit(NO_TITLE))
        .when(F.col("_known"), F.lit(KNOWN_RECORD))
    )
    return joined.withColumn("reject_reason", reason).drop("_known", "page_reject")


# ---- batches -----------------------------------------------------------------------


def assign_batches(urls: DataFrame, size: Column, digits: int = 3) -> DataFrame:
    """Number the rows of each source into batches of exactly ``size`` rows, the
    last one smaller, in the order of the MD5 of their URL.

    ``urls`` has to be distinct on ``(source, url)``. Rows are numbered inside
    buckets of the first hexadecimal ``digits`` and shifted by the sizes of the buckets
    before, so a source of any size is spread over 16 ** digits groups instead of ordered in one.
    """
    placed = urls.withColumn("_hash", F.md5("url")).withColumn("_bucket", F.substring("_hash", 1, digits))
    before = Window.partitionBy("source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        placed.groupBy("source", "_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("source", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    )
    inside = Window.partitionBy("source", "_bucket").orderBy("_hash", "url")
    row = F.col("_shift") + F.col("_row") - 1
    return (
        placed.withColumn("_row", F.row_number().over(inside))
        .join(shifts, ["source", "_bucket"])
        .withColumn("batch_no", (F.floor(row / size) + 1).cast("bigint"))
        .drop("_bucket", "_hash", "_row", "_shift")
    )


def run_progress(rows: DataFrame, block: int = 4096) -> DataFrame:
    """``(source, batch_no, total_batches, saved, total_saved)`` in batch order.

    ``rows`` has ``source``, ``batch_no`` (from 1) and a flag ``saved``. The
    running total works on blocks of batches first and then inside each block,
    so a source with millions of batches is not summed in one task.
    """
    return batch_progress(rows.groupBy("source", "batch_no").agg(F.count_if("saved").alias("saved")), block)


def batch_progress(batches: DataFrame, block: int = 4096) -> DataFrame:
    """``run_progress`` of counts ``(source, batch_no, saved)``, a row a batch."""
    batches = batches.withColumn("_block", F.floor(F.col("batch_no") / block))
    earlier = Window.partitionBy("source").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        batches.groupBy("source", "_block")
        .agg(F.sum("saved").alias("_saved"), F.count(F.lit(1)).alias("_batches"))
        .select(
            "source",
            "_block",
            F.coalesce(F.sum("_saved").over(earlier), F.lit(0)).alias("_before"),
            F.sum("_batches").over(Window.partitionBy("source")).alias("total_batches"),
        )
    )
    inside = (
        Window.partitionBy("source", "_block")
        .orderBy("batch_no")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        batches.withColumn("_run", F.sum("saved").over(inside))
        .join(blocks, ["source", "_block"])
        .select(
            "source",
            "batch_no",
            "total_batches",
            "saved",
            (F.col("_before") + F.col("_run")).alias("total_saved"),
        )
    )


