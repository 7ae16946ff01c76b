"""Groups of records that pairwise matches link directly or indirectly.

Union-find runs inside bounded pieces of the edge list and keeps only a spanning forest of each. The forests are merged
level by level: at each level every vertex points to the best root that any forest gave it, and the roots it got, each with
the next better one, are the edges of the next, smaller level, whose vertices are roots only. Roots are ordered by a hash that changes with the
level, so a constant share of the vertices drops out at every level whatever the input's order, long chains included.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from heddle.operators.union_find import union_find
from heddle.runtime import durable, hot_lookup

_FOREST = "v string, h long, r string"


def _forest(most: int):
    """For batches of (a, ha, b, hb): for each vertex of a piece of at most ``most`` edges the root of its tree."""

    def star(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(batches).combine_chunks()
        both = pa.chunked_array(t["a"].chunks + t["b"].chunks).dictionary_encode().combine_chunks()
        code = both.indices.to_numpy(zero_copy_only=False)
        m, words = len(code) // 2, both.dictionary
        hash_ = np.empty(len(words), dtype=np.int64)
        hash_[code] = np.concatenate([t["ha"].to_numpy(), t["hb"].to_numpy()])
        order = np.argsort(hash_, kind="stable")
        ranked = hash_[order]
        if (ranked[1:] == ranked[:-1]).any():  # equal hashes: the strings decide, alike in every piece
            order = np.array(sorted(range(len(words)), key=lambda i: (hash_[i], words[i].as_py().encode())))
        rank = np.empty_like(order)
        rank[order] = np.arange(len(order))
        root = order[union_find(rank[code[:m]], rank[code[m:]], len(order))[rank]]
        return pa.RecordBatch.from_arrays([words, pa.array(hash_[root]), words.take(pa.array(root))], names=["v", "h", "r"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in batches:
            if b.num_rows:
                held.append(b)
                n += b.num_rows
            if n >= most:
                yield star(held)
                held, n = [], 0
        if held:
            yield star(held)

    return run


def link_groups(pairs: DataFrame, *, a: str, b: str, most: int = 1_000_000) -> DataFrame:
    """(key, group_key) for each key linked to another; ``group_key`` is the smallest key of its group.

    ``pairs`` has one row a match; direction and repeats don't matter. ``most`` bounds the edges that one union-find holds
    in memory; the result doesn't depend on it.

    - Rows with a null in either key, or the same key twice, link nothing; a key only in such rows has no row.
    - Keys are compared as stored, so '' is a key like any other. The smallest is by code point.
    - An empty table gives no rows. Further columns are not read, whatever their names.

    A key in a third of all rows costs no more than others: it enters each forest once, and its roots pass one after the
    other, never gathered in a row. Nothing about vertices or edges goes to the driver except counts.
    """
    edges = pairs.select(F.col(a).cast("string").alias("a"), F.col(b).cast("string").alias("b")).where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
    parents: list[DataFrame] = []
    while True:
        seed = F.lit(len(parents))
        hashed = edges.select("a", F.xxhash64(seed, "a").alias("ha"), "b", F.xxhash64(seed, "b").alias("hb"))
        forest = hashed.mapInArrow(_forest(most), _FOREST)
        better = F.lag("r").over(Window.partitionBy("v").orderBy("h", "r")).alias("better")
        chain = durable(forest.select("v", "r", better).where("better is null or better <> r"))
        parents.append(chain.where("better is null").select("v", F.col("r").alias("up")))
        edges = durable(chain.where("better is not null").select(F.col("better").alias("a"), F.col("r").alias("b")).distinct())
        left = edges.count()
        if not left:
            break
        edges = edges.coalesce(1) if left <= most else edges.repartition(-(-left // most))
    labels = parents.pop()
    while parents:
        # A vertex whose parent isn't a vertex of the level above is in a finished tree: the parent is its root.
        upper = labels.select(F.col("v").alias("up"), F.col("up").alias("root"))
        labels = _climb(parents.pop(), upper)
    labels = durable(labels)
    groups = durable(labels.groupBy("up").agg(F.min("v").alias("group_key"), F.count(F.lit(1)).alias("n")))
    return hot_lookup(labels, groups, ["up"], "n").select(F.col("v").alias("key"), "group_key")


def _climb(lower: DataFrame, upper: DataFrame) -> DataFrame:
    lower = durable(lower)
    use = lower.groupBy("up").agg(F.count(F.lit(1)).alias("n"))
    known = durable(upper.join(use, "up"))
    return hot_lookup(lower, known, ["up"], "n").select("v", F.coalesce("root", "up").alias("up"))
