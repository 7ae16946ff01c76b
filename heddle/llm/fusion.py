"""One surviving record for each group of duplicates, its values fused from sources that err and copy one another.

Every source has an accuracy and every pair of sources a probability of dependence, which shared false values raise most.
A value's posterior comes from the votes of its sources, each counting by its accuracy and less the likelier it is copied
from a source already counted. Accuracies and dependence are estimated in rounds from the posteriors they lead to.

Entities whose claims have the same pattern (which sources agree, whatever the values are) have the same posteriors, so the
rounds run over distinct patterns with their counts. Only figures for sources and pairs of sources reach the driver. With
more sources than that bears, the same rounds are joins and aggregates, and nothing about sources leaves the executors.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heddle.runtime import durable


@dataclass(frozen=True)
class FusionConfig:
    """``copy_rate``: share of its values that a copier copies. ``prior``: probability beforehand that two sources depend on
    each other. ``n_false``: false values that a claim could have. ``most_sources``: up to so many sources their figures are
    arrays on the driver; with more they are tables. The results are the same."""

    rounds: int = 3
    copy_rate: float = 0.8
    prior: float = 0.1
    n_false: int = 10
    start: float = 0.8
    most_sources: int = 1000


@dataclass
class SourceModel:
    names: list[str]
    accuracy: np.ndarray
    depends: np.ndarray = field(repr=False)


class _Votes:
    """A model as plain lists, for many small sums: accuracies, votes, and what is left of a vote beside another source."""

    def __init__(self, model: SourceModel, c: FusionConfig):
        self.accuracy: list[float] = model.accuracy.tolist()
        self.vote = [math.log(c.n_false * a / (1 - a)) for a in self.accuracy]
        self.left: list[list[float]] = (1 - c.copy_rate * model.depends).tolist()
        self.n_false = c.n_false

    def posteriors(self, values: list[int], sources: list[int]) -> list[float]:
        n = max(values) + 1
        by: list[list[int]] = [[] for _ in range(n)]
        for s, v in zip(sources, values):
            by[v].append(s)
        score = []
        for mine in by:
            mine.sort(key=lambda s: (-self.accuracy[s], s))
            total = 0.0
            for i, s in enumerate(mine):
                alone, left = self.vote[s], self.left[s]
                for t in mine[:i]:
                    alone *= left[t]
                total += alone
            score.append(total)
        top = max(*score, 0.0)
        w = [math.exp(x - top) for x in score]
        whole = sum(w) + max(0, self.n_false + 1 - n) * math.exp(-top)
        return [x / whole for x in w]


def posteriors(values: list[int], sources: list[int], model: SourceModel, c: FusionConfig) -> np.ndarray:
    """The posterior of each value 0..max for claims sources[i] -> values[i]."""
    return np.array(_Votes(model, c).posteriors(values, sources))


def _apart(shared: float | None, a: float, b: float, c: FusionConfig) -> float:
    """How much more likely two claims are if neither source copies, as a logarithm. ``shared``: the posterior of the value
    that both claim, or none if they differ. Sharing a value that is likely false speaks for copying, differing against it."""
    if shared is None:
        return -math.log(1 - c.copy_rate)
    alone = shared * a * b + (1 - shared) * (1 - a) * (1 - b) / c.n_false
    mean = (a + b) / 2
    return math.log(alone / (c.copy_rate * (shared * mean + (1 - shared) * (1 - mean)) + (1 - c.copy_rate) * alone))


def _statistics(model: SourceModel, c: FusionConfig):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n = len(model.names)
        votes, sums, pairs = _Votes(model, c), [[0.0, 0.0] for _ in range(n)], {}
        accuracy = votes.accuracy
        for b in batches:
            for pattern, times in zip(b["pattern"], b["times"]):
                src, val = json.loads(pattern)
                p = votes.posteriors(val, src)
                for s, v in zip(src, val):
                    sums[s][0] += p[v] * times
                    sums[s][1] += times
                for i, (s, v) in enumerate(zip(src, val)):
                    for t, w in zip(src[:i], val[:i]):
                        key = (s, t) if s < t else (t, s)
                        pairs[key] = pairs.get(key, 0.0) + times * _apart(p[v] if v == w else None, accuracy[s], accuracy[t], c)
        rows = [(s, s, x, y) for s, (x, y) in enumerate(sums) if y] + [(s, t, x, 0.0) for (s, t), x in pairs.items()]
        yield pd.DataFrame(rows, columns=["s", "t", "x", "y"])

    return run


def estimate_sources(patterns: DataFrame, names: list[str], c: FusionConfig) -> SourceModel:
    """Accuracies and dependence from patterns (pattern, times), in ``c.rounds`` rounds."""
    n = len(names)
    model = SourceModel(names, np.full(n, c.start), np.zeros((n, n)))
    for _ in range(c.rounds):
        sums = patterns.mapInPandas(_statistics(model, c), "s int, t int, x double, y double").groupBy("s", "t").agg(F.sum("x").alias("x"), F.sum("y").alias("y")).toPandas()
        one, two = sums[sums.s == sums.t], sums[sums.s != sums.t]
        accuracy = np.full(n, c.start)
        accuracy[one.s] = np.clip(one.x / one.y, 0.05, 0.99)
        depends = np.zeros((n, n))
        depends[two.s, two.t] = depends[two.t, two.s] = 1 / (1 + (1 - c.prior) / c.prior * np.exp(np.clip(two.x, -700, 700)))
        model = SourceModel(names, accuracy, depends)
    return model


def fuse(claims: DataFrame, *, entity: str, source: str, value: str, at: str | None = None, config: FusionConfig | None = None) -> DataFrame:
    """(entity, value, posterior): for each entity the value with the greatest posterior.

    With ``at``, only values of the newest claims of the entity are eligible, while all claims count as votes.

    - Claims with a null entity, source, value or (if given) time don't count; an entity without others has no row.
    - Of several values that a source claims for an entity the newest counts, then the most frequent, then the greatest.
    - Equal posteriors go to the value of the newest claim, then to the greatest value. Repeated claims count once.
    - Values are compared as stored, of any length. An empty table gives no rows. Further columns are not read.

    Claims are aggregated before each shuffle; an entity keeps at most one claim for each source, however many rows it has.
    """
    c = config or FusionConfig()
    when = F.col(at) if at else F.lit(0)
    rows = claims.select(F.col(entity).alias("entity"), F.col(source).cast("string").alias("source"), F.col(value).cast("string").alias("value"), when.alias("at")).where("entity is not null and source is not null and value is not null and at is not null")
    support = rows.groupBy("entity", "source", "value").agg(F.max("at").alias("at"), F.count(F.lit(1)).alias("n"))
    one = support.groupBy("entity", "source").agg(F.max(F.struct("at", "n", "value")).alias("m")).select("entity", "source", "m.at", "m.value")
    one = durable(one)
    names = [r.source for r in one.select("source").distinct().orderBy("source").limit(c.most_sources + 1).collect()]
    if len(names) > c.most_sources:
        return _fuse_in_tables(one, c, at is not None)
    index = F.broadcast(claims.sparkSession.createDataFrame([(s, i) for i, s in enumerate(names)], "source string, src int"))
    # Python works on little data for long, so parts are cut by rows; partitions by size would leave it to few tasks.
    parts = max(1, min(20_000, -(-one.count() // 20_000)))
    lists = one.join(index, "source").repartition(parts, "entity").groupBy("entity").agg(F.sort_array(F.collect_list(F.struct("src", "value", "at"))).alias("c"))
    values = F.sort_array(F.array_distinct(F.col("c.value")))
    shaped = lists.withColumn("values", values)
    code = F.transform("c", lambda x: F.array_position("values", x["value"]).cast("int") - 1)
    shaped = shaped.withColumn("pattern", F.to_json(F.array(F.col("c.src"), code)))
    newest = F.array_max(F.col("c.at"))
    eligible = F.transform("values", lambda v: F.array_max(F.transform(F.filter("c", lambda x: x["value"] == v), lambda x: x["at"])) == newest)
    if not at:
        eligible = F.lit(None).cast("array<boolean>")  # all claims are of one time
    shaped = durable(shaped.select("entity", "values", "pattern", eligible.alias("fresh")))
    patterns = durable(shaped.groupBy("pattern").agg(F.count(F.lit(1)).alias("times")).repartition(parts))
    model = estimate_sources(patterns, names, c)
    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, list[float]] = {}
        votes = _Votes(model, c)
        for b in batches:
            value, prob = [], []
            for vals, pattern, fresh in zip(b.column("values").to_pylist(), b.column("pattern").to_pylist(), b.column("fresh").to_pylist()):
                if pattern not in known:
                    if len(known) > 100_000:
                        known.clear()
                    src, val = json.loads(pattern)
                    known[pattern] = votes.posteriors(val, src)
                p = known[pattern]
                if fresh is None:
                    best = max(range(len(p)), key=lambda i: (p[i], i))
                else:
                    best = max((i for i in range(len(p)) if fresh[i]), key=lambda i: (p[i], i))
                value.append(vals[best])
                prob.append(float(p[best]))
            yield pa.RecordBatch.from_arrays([b.column("entity"), pa.array(value, pa.string()), pa.array(prob, pa.float64())], names=["entity", "value", "posterior"])

    kind = dict(shaped.dtypes)["entity"]
    return shaped.mapInArrow(pick, f"entity {kind}, value string, posterior double")


def _fuse_in_tables(one: DataFrame, c: FusionConfig, only_newest: bool) -> DataFrame:
    """What :func:`fuse` gives, for any number of sources: accuracies and dependence are tables.

    ``one`` has (entity, source, at, value), one claim for each entity and source. Pairs of claims on an entity are the
    method's unit; those of an entity with many claims are spread over tasks by salts.
    """
    size = one.groupBy("entity").agg(F.count(F.lit(1)).alias("k"), F.max("at").alias("newest"))
    full = durable(one.join(size, "entity"))
    salts = F.ceil(F.col("k") / 1000).cast("int")
    left = full.select("entity", F.col("source").alias("s"), F.col("value").alias("vs"), F.pmod(F.xxhash64("source"), salts).alias("salt"))
    right = full.select("entity", F.col("source").alias("t"), F.col("value").alias("vt"), F.explode(F.sequence(F.lit(0).cast("long"), (salts - 1).cast("long"))).alias("salt"))
    pairs = durable(left.join(right, ["entity", "salt"]).where("s < t").select("entity", "s", "t", "vs", (F.col("vs") == F.col("vt")).alias("same")))
    accuracy = full.select("source").distinct().withColumn("a", F.lit(c.start))
    depends = None
    for i in range(c.rounds + 1):
        voted = full.select("entity", "source", "value", "at", "newest").join(accuracy, "source")
        if depends is None:
            voted = voted.withColumn("alone", F.lit(0.0))
        else:
            one_of = accuracy.select(F.col("source").alias("s"), F.col("a").alias("a_s"))
            other = accuracy.select(F.col("source").alias("t"), F.col("a").alias("a_t"))
            both = pairs.where("same").join(depends, ["s", "t"]).join(one_of, "s").join(other, "t")
            # The less accurate of two, or of equals the later, counts less the likelier it copies.
            later = F.when(F.col("a_t") > F.col("a_s"), F.col("s")).otherwise(F.col("t"))
            less = both.groupBy("entity", later.alias("source")).agg(F.sum(F.log1p(-c.copy_rate * F.col("d"))).alias("less"))
            voted = voted.join(less, ["entity", "source"], "left").withColumn("alone", F.coalesce("less", F.lit(0.0))).drop("less")
        vote = F.exp("alone") * F.log(c.n_false * F.col("a") / (1 - F.col("a")))
        scores = voted.groupBy("entity", "value").agg(F.sum(vote).alias("score"), F.max("at").alias("at"), F.max("newest").alias("newest"))
        tops = scores.groupBy("entity").agg(F.greatest(F.max("score"), F.lit(0.0)).alias("top"), F.count(F.lit(1)).alias("n"))
        scored = scores.join(tops, "entity")
        sums = scored.groupBy("entity").agg((F.sum(F.exp(F.col("score") - F.col("top"))) + F.max(F.greatest(F.lit(0), c.n_false + 1 - F.col("n")) * F.exp(-F.col("top")))).alias("z"))
        chance = durable(scored.join(sums, "entity").select("entity", "value", "at", "newest", (F.exp(F.col("score") - F.col("top")) / F.col("z")).alias("p")))
        if i == c.rounds:
            break
        claims = full.select("entity", "source", "value").join(chance.select("entity", "value", "p"), ["entity", "value"])
        was = accuracy
        accuracy = durable(claims.groupBy("source").agg(F.least(F.greatest(F.avg("p"), F.lit(0.05)), F.lit(0.99)).alias("a")))
        a = was.select(F.col("source").alias("s"), F.col("a").alias("x")), was.select(F.col("source").alias("t"), F.col("a").alias("y"))
        told = pairs.join(chance.select("entity", F.col("value").alias("vs"), "p"), ["entity", "vs"]).join(a[0], "s").join(a[1], "t")
        x, y, p = F.col("x"), F.col("y"), F.col("p")
        alone, mean = p * x * y + (1 - p) * (1 - x) * (1 - y) / c.n_false, (x + y) / 2
        apart = F.when(~F.col("same"), -math.log(1 - c.copy_rate)).otherwise(F.log(alone / (c.copy_rate * (p * mean + (1 - p) * (1 - mean)) + (1 - c.copy_rate) * alone)))
        odds = F.least(F.greatest(F.sum(apart), F.lit(-700.0)), F.lit(700.0))
        depends = durable(told.groupBy("s", "t").agg((1 / (1 + (1 - c.prior) / c.prior * F.exp(odds))).alias("d")))
    fresh = F.col("at") == F.col("newest")
    rows = chance.where(fresh) if only_newest else chance
    best = rows.groupBy("entity").agg(F.max(F.struct("p", fresh.alias("f"), "value")).alias("b"))
    return best.select("entity", F.col("b.value").alias("value"), F.col("b.p").alias("posterior"))


def decide_newest(claims: DataFrame, *, entity: str, source: str, value: str, at: str, config: FusionConfig | None = None) -> DataFrame:
    """(entity, value, posterior): the newest value of each entity; of several the one with the greatest posterior.

    The rules are those of :func:`fuse` with ``at``, and so are the steps: all claims, newest or not, estimate accuracies and
    dependence, and every entity's posteriors come from them, also where its newest claims agree and nothing is left to choose.
    """
    return fuse(claims, entity=entity, source=source, value=value, at=at, config=config)


def golden_records(records: DataFrame, *, entity: str, source: str, fields: list[str], config: FusionConfig | None = None) -> DataFrame:
    """(entity, field, value, posterior): one record for each entity, every field fused from what the sources say of it.

    All fields of all entities estimate the sources together. A null field is no claim; a field nobody claims has no row.
    Otherwise the rules are those of :func:`fuse`.
    """
    cells = F.explode(F.array(*[F.struct(F.lit(i).alias("field"), F.col(f).cast("string").alias("value")) for i, f in enumerate(fields)]))
    claims = records.where(F.col(entity).isNotNull()).select(F.col(entity).alias("e"), F.col(source).alias("source"), cells.alias("c")).select(F.struct("e", "c.field").alias("entity"), "source", "c.value")
    made = fuse(claims, entity="entity", source="source", value="value", config=config)
    return made.select(F.col("entity.e").alias("entity"), F.element_at(F.array(*[F.lit(f) for f in fields]), F.col("entity.field") + 1).alias("field"), "value", "posterior")


def survivors(groups: DataFrame, level: DataFrame, ms: DataFrame, named: DataFrame, ranks: list[str]) -> DataFrame:
    """(group_key, keep_key, name_key) for groups (key, group_key).

    ``keep_key`` is the member with the best level (by place in ``ranks``; others and none last), then the least ms (none
    last), then the smallest key. ``name_key`` is the member with the newest time in ``named``, then the smallest key.
    Inputs have one row a key: level (entity, value), ms (entity, value), named (key, at). Missing keys are as none.
    Joins are on unique keys and the groups are reduced before the shuffle, so a group may hold any share of the rows.
    """
    rank = F.lit(len(ranks))
    for i, v in enumerate(ranks):
        rank = F.when(F.col("level") == v, i).otherwise(rank)
    full = groups.join(level.select(F.col("entity").alias("key"), F.col("value").alias("level")), "key", "left")
    full = full.join(ms.select(F.col("entity").alias("key"), F.col("value").cast("long").alias("ms")), "key", "left").join(named, "key", "left")
    last = F.lit((1 << 62)).cast("long")
    keep = F.min(F.struct(rank.alias("r"), F.coalesce("ms", last).alias("m"), F.col("key").alias("key")))
    name = F.min(F.struct(F.coalesce(-F.unix_micros(F.col("at").cast("timestamp")), last).alias("t"), F.col("key").alias("key")))
    return full.groupBy("group_key").agg(keep.alias("k"), name.alias("n")).select("group_key", F.col("k.key").alias("keep_key"), F.col("n.key").alias("name_key"))
