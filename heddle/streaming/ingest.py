"""Streaming variants: daily drops as a file stream, and the verdict of each key kept up to date.

The library's batch operators cover all data; these run the same logic incrementally with Structured Streaming.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heddle.operators.state import fold_verdicts


def read_drops(spark: SparkSession, path: str, schema: str, files_per_trigger: int = 100) -> DataFrame:
    """A stream over Parquet files as they are dropped into a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def hourly_counts(stream: DataFrame, *, at: str, kind: str, late: str = "1 day") -> DataFrame:
    """(window, kind, n) with late rows up to ``late`` behind the newest."""
    return stream.withWatermark(at, late).groupBy(F.window(at, "1 hour"), kind).agg(F.count(F.lit(1)).alias("n"))


def stream_verdicts(stream: DataFrame, *, key: str) -> DataFrame:
    """(key, level) updates from a stream of (key, priority, rank, evidence, level, at), for output mode update.

    The batch fold is an aggregate over a total order, so the stream is the same aggregate: its state is one row a key, and
    replaying all drops in any order ends with the same verdicts.
    """
    return fold_verdicts(stream, key=key, priority="priority", rank="rank", evidence="evidence", level="level", at="at")
