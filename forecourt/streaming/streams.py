"""Structured Streaming forms of the incremental jobs.

Every query runs with ``availableNow``: it handles all new input and stops, so
a schedule can start it again from its checkpoint. Event-time columns must be
instants (``timestamp``).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from forecourt.functions.periods import period_start
from forecourt.operators.merge import dedupe_newest
from forecourt.streaming.epochs import land

LATE = "3 days"

# window() counts from 1970-01-01, a Thursday; weeks open on Monday.
_WINDOWS = {"day": ("1 day", "0 seconds"), "week": ("7 days", "4 days")}


def file_stream(spark: SparkSession, path: str, schema: StructType | str, fmt: str = "parquet", **options) -> DataFrame:
    """New files under ``path``, each read once per checkpoint."""
    return spark.readStream.format(fmt).schema(schema).options(**options).load(path)


def append_new(stream: DataFrame, path: str, checkpoint: str, partition: str | None = None) -> StreamingQuery:
    """Append all new rows to Parquet; a restart neither loses nor repeats a file."""
    writer = stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if partition:
        writer = writer.partitionBy(partition)
    return writer.format("parquet").start(path)


def tumbling_counts(stream: DataFrame, ts: str, keys: Sequence[str], unit: str, late: str | None = LATE, out: str = "n") -> DataFrame:
    """Count per key and day or week; in append mode a period appears once, after it has closed.

    ``late=None`` keeps the watermark the stream already has.
    """
    size, shift = _WINDOWS[unit]
    period = F.window(ts, size, size, shift)
    marked = stream.withWatermark(ts, late) if late else stream
    counts = marked.groupBy(*keys, period).agg(F.count("*").alias(out))
    return counts.select(*keys, F.col("window.start").alias("date"), out)


def calendar_counts(daily: DataFrame, keys: Sequence[str], unit: str, out: str = "n") -> DataFrame:
    """Closed months, quarters or years from closed days (the output of ``tumbling_counts``).

    Calendar periods have no fixed length, so the stream closes days and the
    longer periods are sums of them.
    """
    bound = period_start(daily.agg(F.max("date") + F.expr("INTERVAL '1' DAY")).scalar(), unit)
    closed = daily.withColumn("date", period_start(F.col("date"), unit)).where(F.col("date") < bound)
    return closed.groupBy(*keys, "date").agg(F.sum(out).alias(out))


def distinct_visits(stream: DataFrame, ts: str, keys: Sequence[str], value: str, late: str = LATE) -> DataFrame:
    """One row per key, day and value. State is dropped once the day is older than the watermark.

    Exact distinct counts per period follow by counting in batch; a longer
    period counts distinct values over its days.
    """
    days = stream.select(*keys, value, F.date_trunc("day", ts).alias("date"))
    return days.withWatermark("date", late).dropDuplicates([*keys, value, "date"])


def union_feeds(feeds: Sequence[DataFrame], ts: str, late: str = LATE) -> DataFrame:
    """Union of streams, each with its own watermark; the slowest decides what is closed.

    That is Spark's default policy, which ``session.tune`` states too.
    """
    marked = [f.withWatermark(ts, late) for f in feeds]
    out = marked[0]
    for f in marked[1:]:
        out = out.unionByName(f)
    return out


def _each_batch(stream: DataFrame, apply: Callable[[DataFrame, int], None], checkpoint: str, mode: str) -> StreamingQuery:
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    return writer.foreachBatch(apply).start()


def upsert_stream(stream: DataFrame, path: str, keys: Sequence[str], ts: str, checkpoint: str, ties: Sequence[Column] = ()) -> StreamingQuery:
    """Land each micro-batch, newest row per key, as a partition of its own; a later batch's row replaces an earlier one's.

    Nothing stored is read or rewritten. Read with ``epochs.newest_rows``, and
    compact from time to time with ``epochs.compact``.
    """
    return _each_batch(stream, lambda batch, epoch: land(dedupe_newest(batch, keys, ts, ties), path, epoch), checkpoint, "append")


def late_counts(stream: DataFrame, ts: str, keys: Sequence[str], path: str, checkpoint: str, late: str = LATE, out: str = "n") -> StreamingQuery:
    """Daily counts kept current while late rows arrive.

    Each batch lands the counts it changed, as a partition of its own; the
    newest one of a key and ``date`` holds. Rows later than ``late`` are
    dropped, as by a job that re-reads that span. Read and compact as
    ``upsert_stream``, by the keys and ``date``.
    """
    days = stream.withColumn("_day", F.date_trunc("day", ts)).withWatermark("_day", late)
    counts = days.groupBy(*keys, F.col("_day").alias("date")).agg(F.count("*").alias(out))
    counts = counts.withColumn("date", F.to_date("date"))
    return _each_batch(counts, lambda batch, epoch: land(batch, path, epoch), checkpoint, "update")
