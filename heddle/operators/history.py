"""Histories: last values, streaks, islands, rings, rotations and deterministic samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heddle.functions.content import md5_mod


def last_n(df: DataFrame, by: str, order: list[Column], n: int) -> DataFrame:
    return df.withColumn("rank_from_last", F.row_number().over(Window.partitionBy(by).orderBy(*order))).where(F.col("rank_from_last") <= n)


def gate(df: DataFrame, *, by: str, success: str, order: list[Column], days: int = 7, max_failures: int = 0, label: Column | None = None) -> DataFrame:
    """(by, admitted, reason): label first, then enough observations, then failures among the last ``days``.

    Rows with null success don't count as observations.
    """
    recent = last_n(df.where(F.col(success).isNotNull()), by, order, days)
    stats = recent.groupBy(by).agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col(success)).alias("fails"))
    marks = df.groupBy(by).agg(F.bool_or(label if label is not None else F.lit(False)).alias("labelled"))
    full = marks.join(stats, by, "left").withColumn("n", F.coalesce("n", F.lit(0))).withColumn("fails", F.coalesce("fails", F.lit(0)))
    reason = F.when(F.col("labelled"), "label").when(F.col("n") < days, "days").when(F.col("fails") > max_failures, "failures").otherwise("")
    return full.select(by, (reason == "").alias("admitted"), reason.alias("reason"))


def promotion(entries: DataFrame, probes: DataFrame, *, id: str, channel: str, label: str, quarantined: DataFrame, success: str, at: str, as_of: str, days: int = 7, max_failures: int = 1, rate: tuple[int, int] = (8, 10), reject_after: int = 21) -> DataFrame:
    """(id, action, reason) of entries on trial, by gates in this order: quarantined channel, label, too few observations,
    failures among the last ``days``, share of successes. All passed promotes; else an entry first seen ``reject_after`` or more
    days before ``as_of`` is rejected, others stay on trial. Observations without a result don't count.

    ``entries`` has id, channel and label (null for none), ``quarantined`` has channel.
    """
    ranked = last_n(probes.where(F.col(success).isNotNull()).select(id, success, at), id, [F.desc(at)], days)
    stats = ranked.groupBy(id).agg(F.count(F.lit(1)).alias("__n"), F.count_if(F.col(success)).alias("__ok"))
    first = probes.groupBy(id).agg(F.min(at).alias("__first"))
    out = quarantined.select(F.col(channel).alias("__c")).where("__c <> ''").distinct()
    full = entries.join(stats, id, "left").join(first, id, "left").join(out, F.col(channel) == F.col("__c"), "left")
    n, ok = F.coalesce("__n", F.lit(0)), F.coalesce("__ok", F.lit(0))
    gates = F.when(F.col("__c").isNotNull(), "quarantine").when(F.col(label).isNotNull(), "label").when(n < days, "days")
    reason = gates.when(n - ok > max_failures, "failures").when(ok * rate[1] < n * rate[0], "rate").otherwise("")
    old = F.coalesce(F.datediff(F.lit(as_of).cast("date"), F.to_date("__first")) >= reject_after, F.lit(False))
    return full.select(id, F.when(reason == "", "promote").when(old, "reject").otherwise("keep").alias("action"), reason.alias("reason"))


def fail_streak(df: DataFrame, *, by: str, day: str, failed: Column, order: str, as_of: str, back: int = 60) -> DataFrame:
    """(by, streak): recorded failing days in a row before ``as_of``; a day's last record counts, missing days are skipped.

    Closed form: failing days after the last day that didn't fail, within ``back`` days.
    """
    rows = df.withColumn("__day", F.to_date(day)).where((F.col("__day") < F.lit(as_of).cast("date")) & (F.col("__day") >= F.date_sub(F.lit(as_of).cast("date"), back)))
    daily = rows.groupBy(by, "__day").agg(F.max_by(failed, order).alias("__bad"))
    last_good = daily.groupBy(by).agg(F.max(F.when(~F.col("__bad"), F.col("__day"))).alias("__good"))
    return daily.join(last_good, by).groupBy(by).agg(F.count_if(F.col("__bad") & (F.col("__good").isNull() | (F.col("__day") > F.col("__good")))).alias("streak"))


def decay_stage(df: DataFrame, *, by: str, day: str, ok: Column, watch: int = 3, out: int = 7) -> DataFrame:
    """(by, streak, stage) from the last run of failing days: active, watch or out; one good day resets."""
    daily = df.groupBy(by, F.to_date(day).alias("__day")).agg(F.bool_or(ok).alias("__ok"))
    good = daily.groupBy(by).agg(F.max(F.when(F.col("__ok"), F.col("__day"))).alias("__good"))
    runs = daily.join(good, by).groupBy(by).agg(F.count_if(~F.col("__ok") & (F.col("__good").isNull() | (F.col("__day") > F.col("__good")))).alias("streak"))
    return runs.withColumn("stage", F.when(F.col("streak") >= out, "out").when(F.col("streak") >= watch, "watch").otherwise("active"))


def latest(df: DataFrame, by: str, order: list[str], keep: list[str]) -> DataFrame:
    """The row with the greatest order of each group, by an aggregate."""
    return df.groupBy(by).agg(F.max_by(F.struct(*keep), F.struct(*order)).alias("__r")).select(by, "__r.*")


def _with_pieces(df: DataFrame, by: list[str], order: str, piece: int, summary: Column, before: Column) -> DataFrame:
    """Adds ``__p``, the piece a row's whole-number order falls in, and ``__before``, what the pieces ahead of it leave."""
    rows = df.withColumn("__p", F.floor(F.col(order) / piece))
    pieces = rows.groupBy(*by, "__p").agg(summary.alias("__s"))
    w = Window.partitionBy(*by).orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    ahead = pieces.select(*[F.col(c).alias(f"__k{i}") for i, c in enumerate(by)], F.col("__p").alias("__q"), before.over(w).alias("__before"))
    on = [F.col(c).eqNullSafe(F.col(f"__k{i}")) for i, c in enumerate(by)] + [F.col("__p") == F.col("__q")]
    return rows.join(ahead, on).drop("__q", *[f"__k{i}" for i in range(len(by))])


def carry(df: DataFrame, *, by: list[str], order: str, state: Column, name: str, piece: int = 1_000_000) -> DataFrame:
    """Carries the last non-null state forward; as one struct, so that parts set together are reset together.

    ``order`` is a whole number. A group is cut every ``piece`` of it; a piece gets what the pieces ahead of it left over
    from one row each, so a group with a third of all rows is spread over many tasks.
    """
    rows = df.withColumn("__v", state)
    left = F.max_by("__v", F.when(F.col("__v").isNotNull(), F.col(order)))
    rows = _with_pieces(rows, by, order, piece, left, F.last("__s", ignorenulls=True))
    w = Window.partitionBy(*by, "__p").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(name, F.coalesce(F.last("__v", ignorenulls=True).over(w), F.col("__before"))).drop("__v", "__p", "__before")


def block_ids(df: DataFrame, *, by: list[str], order: str, starts: Column, piece: int = 1_000_000) -> DataFrame:
    """Numbers the blocks that begin at rows where ``starts`` holds; cut into pieces like :func:`carry`."""
    rows = df.withColumn("__v", F.when(starts, 1).otherwise(0))
    rows = _with_pieces(rows, by, order, piece, F.sum("__v"), F.sum("__s"))
    w = Window.partitionBy(*by, "__p").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("block", F.sum("__v").over(w) + F.coalesce("__before", F.lit(0))).drop("__v", "__p", "__before")


def rank_in_pieces(df: DataFrame, *, by: list[str], order: str, name: str, piece: int = 1_000_000) -> DataFrame:
    """Ranks rows from 1 by ``order``, a whole number, within each group; cut into pieces like :func:`carry`."""
    rows = _with_pieces(df, by, order, piece, F.count(F.lit(1)), F.sum("__s"))
    w = Window.partitionBy(*by, "__p").orderBy(order)
    return rows.withColumn(name, (F.row_number().over(w) + F.coalesce("__before", F.lit(0))).cast("int")).drop("__p", "__before")


def rotation_window(df: DataFrame, *, key: str, day: str, width: int) -> DataFrame:
    """The keys of today's window: sorted, starting at md5(day) modulo their number, wrapping round.

    Ranks come from a range partition with per-partition counts, so no task sorts all keys.
    """
    ranked = global_rank(df.select(key).distinct(), [key])
    n = ranked.count()
    if not n:
        return ranked.select(key)
    start = md5_mod(F.lit(day), n)
    return ranked.where(F.pmod(F.col("rank") - start, F.lit(n)) < width).select(key)


def global_rank(df: DataFrame, order: list[str]) -> DataFrame:
    """Adds ``rank`` from 0 in a total order without moving everything into one task."""
    from heddle.runtime import durable

    parts = durable(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__p", F.spark_partition_id()))
    sizes = parts.groupBy("__p").agg(F.count(F.lit(1)).alias("__n"))
    offsets = sizes.withColumn("__o", F.coalesce(F.sum("__n").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("__p", "__o")
    w = Window.partitionBy("__p").orderBy(*order)
    return parts.withColumn("__i", F.row_number().over(w) - 1).join(F.broadcast(offsets), "__p").withColumn("rank", F.col("__o") + F.col("__i")).drop("__p", "__i", "__o")


def hash_sample(df: DataFrame, key: str, seed: str, k: int | None = None, ratio: tuple[int, int] | None = None) -> DataFrame:
    """A repeatable sample of ``k`` rows, or of the ``ratio`` of all rows but at least one: those with the least hash of seed
    and key. The limit is the feature."""
    if ratio is not None:
        k = max(1, df.count() * ratio[0] // ratio[1])
    return df.orderBy(F.md5(F.concat(F.lit(seed), F.col(key).cast("string"))), key).limit(k)


def upper_median(df: DataFrame, by: str, value: str) -> DataFrame:
    """Element n // 2 of the sorted values; found by counting values up, so a hot group is reduced before the shuffle."""
    counts = df.where(F.col(value).isNotNull()).groupBy(by, value).agg(F.count(F.lit(1)).alias("c"))
    w = Window.partitionBy(by)
    run = counts.withColumn("n", F.sum("c").over(w)).withColumn("upto", F.sum("c").over(w.orderBy(value).rowsBetween(Window.unboundedPreceding, 0)))
    return run.where(F.col("upto") > F.floor(F.col("n") / 2)).groupBy(by).agg(F.min(value).alias("median"))
