"""New records of a stream by keyed state, in place of a table of known keys that every micro-batch reads.

One state a pair of id and posted date: the latest day a record of it was kept. A record is known
when a micro-batch before has kept one of its pair on a day in the look-back from its own day; equal pairs
in one micro-batch are all kept. No record is too late to be looked at. A state that has not
changed for the time it has to be kept is dropped, so states number as the pairs of that time, however long
the stream runs. The state lives in the checkpoint and survives a restart.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from joblark.functions.text import or_empty
from joblark.operators.incremental import LOOK_BACK_DAYS, PAIR

DAY_MS = 86_400_000
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class NewPairs(StatefulProcessor):
    """Keeps the records of a pair that are new; ``_day`` is the day of a record, as a number.

    Every call on a state is a message to the JVM and back, so a pair takes one to read its state and, if a
    record is kept, one to write it; Spark itself drops states whose time is over.
    """

    def __init__(self, look_back_days: int, keep_ms: int):
        self.look_back, self.keep_ms = look_back_days, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.kept = handle.getValueState("kept", "day int", ttlDurationMs=self.keep_ms)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        before = self.kept.get()
        since = before[0] + self.look_back if before else None
        latest = None
        for row in rows:
            day = row["_day"]
            if since is None or day > since:
                latest = day if latest is None else max(day, latest)
                yield row
        if latest is not None:
            self.kept.update((latest,))

    def close(self) -> None:
        pass


def new_pairs(records: DataFrame, look_back_days: int = LOOK_BACK_DAYS, keep_ms: int | None = None) -> DataFrame:
    """The records ``(job_id, posted_date, crawled_at, ...)`` of a stream that are new; absent ids and dates are "".

    A state is kept for ``keep_ms`` of the cluster's time, a day more than the look-back unless given: long enough
    for a stream that keeps up with its pages. A record without ``crawled_at`` counts as one of day 0.
    """
    day = F.coalesce(F.unix_date(F.to_date("crawled_at")), F.lit(0))
    keyed = records.withColumns({**{c: or_empty(F.col(c)) for c in PAIR}, "_day": day})
    out = T.StructType([T.StructField(f.name, f.dataType, True) for f in keyed.schema.fields])
    processor = NewPairs(look_back_days, (look_back_days + 1) * DAY_MS if keep_ms is None else keep_ms)
    kept = keyed.groupBy(*PAIR).transformWithState(
        statefulProcessor=processor, outputStructType=out, outputMode="append", timeMode="ProcessingTime"
    )
    return kept.drop("_day")


@contextmanager
def _settings(spark: SparkSession):
    """What a query takes from the session when it starts: the state store that this needs, and no
    batches without data, which would follow each other without end while states can expire."""
    wanted = {STATE_STORE: ROCKSDB, "spark.sql.streaming.noDataMicroBatches.enabled": "false"}
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value) if value else spark.conf.unset(name)


def start_new_pairs(
    records: DataFrame, path: str, checkpoint: str, look_back_days: int = LOOK_BACK_DAYS, keep_ms: int | None = None
) -> StreamingQuery:
    """Append the new records of all that is available to the parquet files in ``path``, each once, then stop."""
    with _settings(records.sparkSession):
        kept = new_pairs(records, look_back_days, keep_ms)
        writer = kept.writeStream.format("parquet").outputMode("append").option("path", path)
        return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
