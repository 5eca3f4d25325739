"""Streams: pooled error counts over a growing record, and windowed counts of events.

Pooled counts are sums, so a stream adds to them without seeing old rows again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.operators.scoring import COUNTS, scored

RECORD = "id string, reference string, hypothesis string, error string, split string, session_id string, speaker_id string, prompt_id string, device string, environment string, duration double, long_form boolean"


def record_stream(spark: SparkSession, directory: str) -> DataFrame:
    """New record lines of a directory of JSON lines files."""
    return spark.readStream.schema(RECORD).json(directory)


def pooled_stream(rows: DataFrame, keys: tuple[str, ...] = ("split",)) -> DataFrame:
    """Running pooled counts by tier and ``keys``; use output mode ``complete`` or ``update``."""
    scores = scored(rows)
    return scores.groupBy("tier", *keys).agg(*[F.sum(c).alias(c) for c in COUNTS], F.sum(F.col("sentence_error").cast("long")).alias("sentence_errors"), F.count("*").alias("samples"))


def windowed_counts(events: DataFrame, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Events and their values by type and tumbling window of event time; rows later than ``late`` are left out of closed windows."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("events"), F.sum("value").alias("total")).select(F.col("w.start").alias("window_start"), "event_type", "events", "total")


def finished(stream: DataFrame, checkpoint: str, mode: str = "complete") -> DataFrame:
    """Runs a stream over all input that is there, then stops; the final state of its in-memory sink, for aggregates of bounded size."""
    name = "stream_" + checkpoint.replace("/", "_").replace("-", "_").replace(":", "_").replace(".", "_")
    writing = stream.writeStream.outputMode(mode).format("memory").queryName(name).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    writing.awaitTermination()
    return stream.sparkSession.table(name)
