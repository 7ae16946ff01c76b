"""Changes between consecutive full snapshots of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heddle.runtime import broadcast_if_small


def row_hash(*columns: str | Column) -> Column:
    """A 128-bit hash of the values as stored, as two whole numbers; null differs from every value and equals null.

    Each value enters with its length, so neighbouring values can't run into one another.
    """
    parts = []
    for c in columns:
        v = (F.col(c) if isinstance(c, str) else c).cast("string")
        parts += [F.coalesce(F.length(v), F.lit(-1)), v]
    return F.struct(F.xxhash64(F.lit(1), *parts).alias("a"), F.xxhash64(F.lit(2), *parts).alias("b"))


def latest_rows(df: DataFrame, group: list[str], order: str, value: Column, name: str) -> DataFrame:
    """For each group the value of the row with the greatest ``order``; nulls come first, ties go to the greatest value.

    A partial aggregate on each side of the shuffle, so a key that holds a third of all rows moves as one row a task.
    """
    return df.groupBy(*group).agg(F.max(F.struct(F.col(order).alias("o"), value.alias("v"))).alias("_best")).select(*group, F.col("_best.v").alias(name))


def snapshot_changes(df: DataFrame, *, date: str, key: str, order: str, compare: list[str], keep: list[str] | None = None) -> DataFrame:
    """Added, removed and changed keys between consecutive snapshots: (date, key, change_kind).

    Full outer join, on snapshot and key, of each snapshot with the one before it, comparing row hashes of ``compare``.

    - The snapshots are the distinct non-null dates in their order; gaps in the calendar don't matter. The first has no rows.
    - Of several rows for a key in a snapshot the one with the greatest ``order`` counts (null is least; a tie goes to the
      greater hash). Rows with a null or blank key or a null date don't count; other keys are compared as stored.
    - Null equals null and differs from every value, the empty string too. Repeated rows change nothing.
    - An empty table gives no rows. Further columns of ``df`` are not read, whatever their names.
    """
    rows = df.select(F.col(date).alias("_date"), F.col(key).alias("_key"), F.col(order).alias("_order"), row_hash(*compare).alias("_hash"))
    rows = rows.where(F.col("_date").isNotNull() & F.col("_key").isNotNull() & F.col("_key").rlike(r"(?U)\S"))
    state = latest_rows(rows, ["_date", "_key"], "_order", F.col("_hash"), "_hash")
    dates = df.select(F.col(date).alias("_date")).where(F.col("_date").isNotNull()).distinct()
    # One row a snapshot: the window is over snapshots, never over rows.
    steps = dates.select("_date", F.lead("_date").over(_ordered()).alias("_next"), F.lag("_date").over(_ordered()).alias("_last"))
    steps = broadcast_if_small(steps, 1_000_000)
    now = state.join(steps.where(F.col("_last").isNotNull()).select("_date"), "_date").select("_date", "_key", F.col("_hash").alias("_now"))
    before = state.join(steps.where(F.col("_next").isNotNull()), "_date").select(F.col("_next").alias("_date"), "_key", F.col("_hash").alias("_was"))
    kind = F.when(F.col("_was").isNull(), "added").when(F.col("_now").isNull(), "removed").when(F.col("_now") != F.col("_was"), "changed")
    both = now.join(before, ["_date", "_key"], "full_outer").withColumn("change_kind", kind).where(F.col("change_kind").isNotNull())
    return both.select(F.col("_date").alias(date), F.col("_key").alias(key), "change_kind")


def _ordered():
    from pyspark.sql import Window

    return Window.orderBy("_date")
