"""Pairs of sets that overlap above a Jaccard threshold: the kernel, over classes of equal sets.

Tokens are ordered rare to frequent; two sets that reach the threshold share at least l tokens among the first
n - ceil(t n) + l of each (the l-prefix), and the first l tokens that they share are among them. The join key starts as one
token of the 1-prefix. Where a key is held by too many records, and only there, the prefix is extended by one and the key
becomes a combination with one more token, which comes later in the set's order, level after level. So frequent tokens cost
combinations, rare ones don't, and each combination has one key.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heddle.operators.blocks import block_pairs
from heddle.runtime import durable


def set_classes(rows: DataFrame, least: int = 1) -> tuple[DataFrame, DataFrame]:
    """Members (with ``cls`` in place of type and set) and classes (cls, type, toks, size, copies) of records of equal type and set.

    ``rows`` has id, type, set (an array of strings, repeats don't count) and what else members keep; records with fewer than
    ``least`` entries are left out. ``toks`` are 64-bit hashes of the entries and ``cls`` is a hash of type and those in 16 bytes:
    two entries of one pair of sets would have to agree in 64 bits to be confused.
    """
    more = [c for c in rows.columns if c not in ("id", "type", "set")]
    toks = F.sort_array(F.array_distinct(F.transform("set", lambda x: F.xxhash64(x))))
    rows = rows.select("id", "type", toks.alias("toks"), *more).where(F.size("toks") >= least)
    half = lambda n: F.lpad(F.hex(F.xxhash64(F.lit(n), "type", F.size("toks"), "toks")), 16, "0")
    rows = durable(rows.select("id", "type", F.unhex(F.concat(half(1), half(2))).alias("cls"), "toks", *more))
    classes = rows.groupBy("cls").agg(F.first("type").alias("type"), F.first("toks").alias("toks"), F.countDistinct("id").alias("copies"))
    classes = durable(classes.withColumn("size", F.size("toks")))
    return rows.select("id", "cls", *more), classes


def _order_tokens(hot: object):
    """Each set rare to frequent: tokens that aren't hot first, by hash, then the hot ones by frequency."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token, freq = hot.value
        for b in batches:
            lists = b.column("toks")
            flat, at = lists.flatten().to_numpy(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
            f = np.zeros(len(flat), dtype=np.int64)
            if len(token) and len(flat):
                i = np.minimum(np.searchsorted(token, flat), len(token) - 1)
                f = np.where(token[i] == flat, freq[i], 0)
            row = np.repeat(np.arange(len(at) - 1), np.diff(at))
            ordered = pa.ListArray.from_arrays(pa.array(at, type=pa.int32()), pa.array(flat[np.lexsort((flat, f, row))]))
            yield pa.RecordBatch.from_arrays([b.column("cls"), b.column("type"), ordered, b.column("size")], names=["cls", "type", "toks", "size"])

    return run


def similar_classes(classes: DataFrame, threshold: float, *, most: int = 100, levels: int = 4, hot_tokens: int = 200_000) -> DataFrame:
    """(a, b, common, both) for classes a < b of the same type with |common| / |all| >= threshold; ``both`` are the sizes added.

    ``most`` is the number of holders above which a key is lengthened. Keys still above it at the last level are joined in
    blocks of ``most`` by ``most``, so no task holds a whole group and no pair is lost.
    """
    spark = classes.sparkSession
    top, base = _ratio(threshold)
    total = classes.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    # At most total / line tokens are hot: the bound of what is sent to the executors.
    line = max(32, -(-int(total) // hot_tokens))
    counts = classes.select(F.explode("toks").alias("tok")).groupBy("tok").count().where(F.col("count") > line).toPandas()
    counts = counts.sort_values("tok")
    hot = spark.sparkContext.broadcast((counts["tok"].to_numpy(np.int64), counts["count"].to_numpy(np.int64)))
    ordered = durable(classes.select("cls", "type", "toks", "size").mapInArrow(_order_tokens(hot), f"cls binary, type {dict(classes.dtypes)['type']}, toks array<long>, size int"))
    need = F.ceil((F.col("size") * top) / F.lit(base)).cast("int")
    prefix = lambda n: F.slice("toks", 1, F.least(F.col("size"), F.col("size") - need + n))
    keys = ordered.select("cls", "size", "type", F.lit(0).cast("long").alias("used"), F.lit(0).alias("last"), "toks")
    found: list[DataFrame] = []
    for level in range(1, levels + 1):
        # Only the key travels; sets are fetched again for the holders of hot keys.
        # The last token of the key is at place ``last`` of the set; only what comes after it makes a new combination.
        later = F.filter(F.transform(prefix(level), lambda x, i: F.struct(x.alias("tok"), (i + 1).alias("last"))), lambda x: x["last"] > F.col("last"))
        longer = keys.select("cls", "size", "type", "used", F.explode(later).alias("t")).select("cls", "size", "type", "used", "t.tok", "t.last")
        longer = longer.select("cls", "size", F.xxhash64("type", "used", "tok").alias("key"), "type", "last")
        holders = longer.groupBy("key").count().where("count > 1")
        small = holders if level == levels else holders.where(F.col("count") <= most)
        rows = longer.select("cls", "size", "key")
        if level < levels:
            found.append(_pairs(rows.join(small.select("key"), "key"), top, base))
            keys = durable(longer.join(holders.where(F.col("count") > most), "key").select("cls", "size", "type", "last", F.col("key").alias("used"), "key", "count"))
            # Sets so small that a pair may share no more tokens than the key has: a longer key would lose that pair.
            found.append(block_pairs(keys.where(need <= level), key=["key"], item="cls", count="count", most=most, carry=["size"], fit=_sizes_fit(top, base)))
            if keys.isEmpty():
                break
            keys = keys.join(ordered.select("cls", "toks"), "cls")
        else:
            found.append(block_pairs(rows.join(small, "key"), key=["key"], item="cls", count="count", most=most, carry=["size"], fit=_sizes_fit(top, base)))
    pairs = found[0]
    for p in found[1:]:
        pairs = pairs.unionByName(p)
    pairs = pairs.distinct()
    sets = ordered.select("cls", "toks")
    full = pairs.join(sets.select(F.col("cls").alias("a"), F.col("toks").alias("ta")), "a").join(sets.select(F.col("cls").alias("b"), F.col("toks").alias("tb")), "b")
    full = full.select("a", "b", F.size(F.array_intersect("ta", "tb")).alias("common"), (F.size("ta") + F.size("tb")).alias("both"))
    return full.where(F.col("common") * base >= (F.col("both") - F.col("common")) * top).select("a", "b", "common", "both")


def _ratio(threshold: float) -> tuple[int, int]:
    """The threshold as a ratio of integers, so that equality is exact."""
    from fractions import Fraction

    f = Fraction(str(threshold))
    return f.numerator, f.denominator


def _sizes_fit(top: int, base: int) -> Column:
    return (F.col("size") * base >= F.col("size_b") * top) & (F.col("size_b") * base >= F.col("size") * top)


def _pairs(rows: DataFrame, top: int, base: int) -> DataFrame:
    other = rows.select("key", F.col("cls").alias("b"), F.col("size").alias("size_b"))
    return rows.join(other, "key").where((F.col("cls") < F.col("b")) & _sizes_fit(top, base)).select(F.col("cls").alias("a"), "b")
