"""The event feed as a stream.

The event cleaner is stateless, so the batch function runs unchanged on a
streaming DataFrame; ``start_event_cleaning`` appends newly arrived raw event
files, cleaned, to a date-partitioned table (the file sink's commit log makes
the append exactly-once across restarts).  ``start_funnel_counts`` and
``start_cohorts`` add what each micro-batch changes to logs (``plans.incremental``),
so the activation and retention marts equal the batch result at all times
without reading old events again.  There is no watermark, so nothing is dropped
as late and the newest days are present.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from growthlens.operators.staging import clean_posthog
from growthlens.plans.incremental import add_funnel_counts, add_user_days
from growthlens.sources.schemas import POSTHOG_RAW


def clean_event_stream(spark: SparkSession, raw_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Cleaned events from raw event files arriving in ``raw_dir`` (declared schema)."""
    reader = spark.readStream.schema(POSTHOG_RAW).format("parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return clean_posthog(reader.load(raw_dir))


def _start(df: DataFrame, out_dir: str, checkpoint_dir: str, available_now: bool, processing_time: str | None,
           partition_by: list[str] | None = None) -> StreamingQuery:
    writer = (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint_dir)
        .option("path", out_dir)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def start_event_cleaning(
    spark: SparkSession,
    raw_dir: str,
    out_dir: str,
    checkpoint_dir: str,
    available_now: bool = True,
    processing_time: str | None = None,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Clean raw event files as they arrive and append them to a table partitioned by ``event_date``."""
    cleaned = clean_event_stream(spark, raw_dir, max_files_per_trigger)
    return _start(cleaned, out_dir, checkpoint_dir, available_now, processing_time, partition_by=["event_date"])


def _start_batches(
    stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint_dir: str, available_now: bool, processing_time: str | None
) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint_dir)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def start_funnel_counts(
    spark: SparkSession,
    raw_dir: str,
    out_dir: str,
    checkpoint_dir: str,
    available_now: bool = True,
    processing_time: str | None = None,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Adds the counts of each micro-batch to the log under ``out_dir``; ``funnel_counts_so_far`` reads their sum.

    No batch reads earlier events.  A batch that is repeated after a failure
    replaces its own counts, so the sums stay exact; late files are counted on
    their own days.  ``available_now`` processes what is there and stops;
    otherwise the query runs continuously on ``processing_time`` triggers.
    """
    stream = clean_event_stream(spark, raw_dir, max_files_per_trigger)
    return _start_batches(
        stream, lambda batch, k: add_funnel_counts(batch, out_dir, k), checkpoint_dir, available_now, processing_time
    )


def start_cohorts(
    spark: SparkSession,
    raw_dir: str,
    out_dir: str,
    checkpoint_dir: str,
    available_now: bool = True,
    processing_time: str | None = None,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Takes each micro-batch into the cohorts under ``out_dir``; ``retention_so_far`` reads the mart.

    Late files move users to earlier cohorts; a repeated batch changes nothing.
    """
    stream = clean_event_stream(spark, raw_dir, max_files_per_trigger)
    return _start_batches(stream, lambda batch, k: add_user_days(batch, out_dir, k), checkpoint_dir, available_now, processing_time)
