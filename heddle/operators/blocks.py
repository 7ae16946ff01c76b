"""Pairs within groups of any size, without a group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def block_pairs(rows: DataFrame, *, key: list[str], item: str, count: str, most: int, carry: list[str] | None = None, fit: Column | None = None, keep: list[Column] | None = None) -> DataFrame:
    """(a, b) for items a < b of one group, each pair once for each group both are in.

    A group of ``count`` rows is cut into blocks of about ``most`` by the items' hashes, and every item goes to the pairs of
    blocks that contain its own. A task gets pairs of blocks, not groups; small groups are one block and are not copied.
    ``carry`` columns are there as they are for a and with the suffix _b for b, for the condition ``fit`` and for the columns
    ``keep`` that are added.
    """
    more = carry or []
    blocks = F.ceil(F.col(count) / F.lit(most)).cast("int")
    cut = rows.select(*key, item, *more, blocks.alias("__n")).withColumn("__own", F.pmod(F.xxhash64(item), F.col("__n")).cast("int"))
    cut = cut.withColumn("__other", F.explode(F.sequence(F.lit(0), F.col("__n") - 1)))
    cut = cut.select(*key, item, *more, "__own", F.least("__own", "__other").alias("__lo"), F.greatest("__own", "__other").alias("__hi"))
    far = cut.select(*key, "__lo", "__hi", F.col(item).alias("__b"), *[F.col(c).alias(f"{c}_b") for c in more], F.col("__own").alias("__own_b"))
    met = (F.col("__lo") == F.col("__hi")) | (F.col("__own") != F.col("__own_b"))
    both = cut.join(far, [*key, "__lo", "__hi"]).where(met & (F.col(item) < F.col("__b")))
    return (both.where(fit) if fit is not None else both).select(F.col(item).alias("a"), F.col("__b").alias("b"), *(keep or []))
