"""Clusters of mirrors: sketches, near-duplicate pairs, components and the keeper of each."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heddle.functions.content import sketch_value
from heddle.functions.names import title_norm
from heddle.functions.urls import host_of
from heddle.operators.blocks import block_pairs
from heddle.operators.overlap import set_classes, similar_classes
from heddle.operators.union_find import union_find
from heddle.runtime import durable, hot_lookup


def title_list(c: Column) -> Column:
    """Normalised titles without blank ones."""
    return F.filter(F.transform(F.coalesce(c, F.array()), title_norm), lambda x: x != "")


def title_set(c: Column) -> Column:
    return F.sort_array(F.array_distinct(title_list(c)))


def sketch(titles: Column, k: int = 64) -> Column:
    """The ``k`` least hash values of a set."""
    return F.slice(F.sort_array(F.array_distinct(F.transform(titles, sketch_value))), 1, k)


def mirror_pairs(df: DataFrame, *, id: str, type: str, titles: str, total: str, api: str, least: int = 5, strict: tuple[int, int] = (8, 10), loose: tuple[int, int] = (5, 10), tolerance: tuple[int, int] = (15, 100)) -> DataFrame:
    """(a, b, rule) for records of one type that are one library, or the same function under another host.

    Library: title overlap from ``strict`` and totals within ``tolerance`` (missing totals pass). Function: overlap from
    ``loose`` and different hosts. Records of one type and set of titles are one class; classes are joined at ``loose`` by
    the prefixes of :mod:`heddle.operators.overlap`, so no pair is missed and no type is crossed with itself.
    """
    rows = df.select(F.col(id).alias("id"), F.col(type).alias("type"), title_list(F.col(titles)).alias("set"), F.col(total).alias("total"), host_of(F.col(api)).alias("host"))
    members, classes = set_classes(rows.where(F.col("id").isNotNull() & F.col("type").isNotNull()), least)
    links = durable(similar_classes(classes, loose[0] / loose[1]))

    def rule(total_b: str, host_b: str, common: Column, union: Column) -> Column:
        apart = F.abs(F.col("total") - F.col(total_b)) * tolerance[1] > F.greatest("total", total_b) * tolerance[0]
        near = F.when((F.coalesce("total", F.lit(0)) != 0) & (F.coalesce(total_b, F.lit(0)) != 0), ~apart).otherwise(True)
        library = (common * strict[1] >= union * strict[0]) & near
        return F.when(library, "library").when((F.col("host") != F.col(host_b)) & (common * loose[1] >= union * loose[0]), "function")

    far = members.select(F.col("cls").alias("b"), F.col("id").alias("id_b"), F.col("total").alias("total_b"), F.col("host").alias("host_b"))
    across = links.join(members.withColumnRenamed("cls", "a"), "a").join(far, "b")
    across = across.select("id", "id_b", rule("total_b", "host_b", F.col("common"), F.col("both") - F.col("common")).alias("rule")).where("rule is not null and id <> id_b")
    shared = durable(classes.where("copies > 1").select("cls", "copies"))
    copies = hot_lookup(members, shared, ["cls"], "copies").where("copies is not null")
    same = rule("total_b", "host_b", F.lit(1), F.lit(1))
    inside = block_pairs(copies, key=["cls"], item="id", count="copies", most=1000, carry=["total", "host"], fit=same.isNotNull(), keep=[same.alias("rule")])
    both = across.select(F.least("id", "id_b").alias("a"), F.greatest("id", "id_b").alias("b"), "rule")
    return both.unionByName(inside).groupBy("a", "b").agg(F.max("rule").alias("rule"))


def _roots(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held = [b for b in batches if len(b)]
    if held:
        e = pd.concat(held)
        ids, code = np.unique(np.concatenate([e["u"].to_numpy(), e["v"].to_numpy()]), return_inverse=True)
        yield pd.DataFrame({"id": ids, "root": ids[union_find(code[: len(e)], code[len(e) :], len(ids))]})


def components(edges: DataFrame, a: str = "a", b: str = "b", in_one_task: int = 1_000_000) -> DataFrame:
    """(id, root): the least id of each component, by alternating large and small stars until nothing moves.

    At most ``in_one_task`` distinct edges are united by union-find in a single task instead.

    Rounds grow with the logarithm of the size. Each is written to the shared folder, so no lineage builds up. A star's
    centre keeps only its least neighbour by an aggregate, and hubs' edges are looked up where they are.
    """
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    e = durable(e)
    if e.count() <= in_one_task:
        kind = dict(e.dtypes)["u"]
        return e.coalesce(1).mapInPandas(_roots, f"id {kind}, root {kind}")
    mark = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = durable(both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")).select("u", F.least("u", "m").alias("m"), "n"))
        large = hot_lookup(both.where("v > u"), least, ["u"], "n").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = durable(large)
        low = durable(large.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")))
        small = hot_lookup(large, low, ["u"], "n").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("p")).select("p.u", "p.v")
        e = durable(small.where("u <> v").distinct())
        now = e.agg(F.count(F.lit(1)), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0))).first()
        if now == mark:
            break
        mark = now
    return e.select(F.col("u").alias("id"), F.col("v").alias("root")).unionByName(e.select(F.col("v").alias("id"), F.col("v").alias("root")).distinct())
