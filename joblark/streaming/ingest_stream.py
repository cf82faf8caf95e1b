"""Detail pages as a stream: every micro-batch runs the batch job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from joblark.plans.ingest import IngestOptions, run
from joblark.schemas import DETAIL_PAGE
from joblark.sources.spec import SourceSpec
from joblark.sources.store import Store


def page_stream(spark: SparkSession, path: str, files_per_batch: int = 1000, **options: str) -> DataFrame:
    """New parquet files of fetched pages, some files per micro-batch."""
    reader = spark.readStream.schema(DETAIL_PAGE).option("maxFilesPerTrigger", files_per_batch)
    return reader.options(**options).parquet(path)


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The identity of a stream, which its checkpoint keeps."""
    return spark.read.text(f"{checkpoint}/metadata").select(F.get_json_object("value", "$.id").alias("id")).first()["id"]


def start_ingest(
    pages: DataFrame,
    specs: tuple[SourceSpec, ...],
    store: Store,
    checkpoint: str,
    options: IngestOptions = IngestOptions(on_gate="reject"),
) -> StreamingQuery:
    """Ingest all pages that are available, then stop.

    Every micro-batch is a run named after the stream's own identity and the
    batch's number, so that streams share a store, and one that starts anew finds nothing of
    an old one. A micro-batch that runs again saves the same rows once. Rows saved
    by earlier micro-batches count as known for the later ones. Failed batches are
    left out and reported: to raise would stop the stream at every restart.
    """

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        oldest = batch.agg(F.to_date(F.min("crawled_at")).alias("day")).first()["day"]
        if oldest is None:
            return
        name = stream_id(batch.sparkSession, checkpoint)
        # look back from the pages' own time, as another attempt has to
        run(
            batch, specs, store, options=options, as_of=F.lit(oldest),
            run_id=f"{name}-{batch_id}", earlier=f"{name}-{batch_id - 1}",
        )

    return (
        pages.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
