"""Diffs, merges and lookups between two versions or two copies of a table. Equi-joins only; conditions joined by OR are
taken one by one and coalesced, so nothing falls back to a nested loop."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def lookup(df: DataFrame, ref: DataFrame, on: dict[str, str], value: str, default: object, name: str) -> DataFrame:
    """Left lookup of one value with a default. ``ref`` must have one row a key."""
    r = ref.select(*[F.col(v).alias(f"__{k}") for k, v in on.items()], F.col(value).alias("__value"))
    cond = [F.col(k) == F.col(f"__{k}") for k in on]
    return df.join(r, cond, "left").withColumn(name, F.coalesce("__value", F.lit(default))).drop("__value", *[f"__{k}" for k in on])


def field_diff(before: DataFrame, after: DataFrame, *, key: str, fields: list[str]) -> DataFrame:
    """(key, status, changed): added, removed or modified rows and the names of the fields that differ, nulls compared."""
    p = before.select(F.col(key).alias("__k"), F.struct(*fields).alias("__p"))
    c = after.select(F.col(key), F.struct(*fields).alias("__c"))
    both = c.join(p, F.col(key) == F.col("__k"), "full_outer")
    names = F.array_compact(F.array(*[F.when(~F.col(f"__c.{f}").eqNullSafe(F.col(f"__p.{f}")), F.lit(f)) for f in fields]))
    status = F.when(F.col("__p").isNull(), "added").when(F.col("__c").isNull(), "removed").when(F.size(names) > 0, "modified")
    changed = F.when(status == "modified", F.array_join(names, ",")).otherwise("")
    return both.select(F.coalesce(key, "__k").alias(key), status.alias("status"), changed.alias("changed")).where("status is not null")


def health_diff(before: DataFrame, after: DataFrame, *, key: str, fingerprint: Column, health: str, good: tuple[str, ...] = ("healthy", "degraded")) -> DataFrame:
    """(key, change): new, gone, down or recovered; a row is the same if its fingerprint is, or else its key.

    Of earlier rows with one fingerprint the one with the least key counts.
    """
    prev = before.select(F.col(key).alias("pk"), fingerprint.alias("pf"), F.coalesce(health, F.lit("unknown")).alias("ph"))
    cur = after.select(F.col(key).alias("k"), fingerprint.alias("f"), F.coalesce(health, F.lit("unknown")).alias("h"))
    by_fp = prev.where("pf <> ''").groupBy("pf").agg(F.min_by("ph", "pk").alias("fh"))
    full = cur.join(by_fp, F.col("f") == F.col("pf"), "left").join(prev.select("pk", "ph"), F.col("k") == F.col("pk"), "left")
    old = F.coalesce("fh", "ph")
    change = F.when(old.isNull(), "new").when(old.isin(*good) & (F.col("h") == "dead"), "down").when((old == "dead") & F.col("h").isin(*good), "recovered")
    moved = full.select(F.col("k").alias("key"), change.alias("change")).where("change is not null")
    gone = prev.join(cur.where("f <> ''").select(F.col("f").alias("pf")).distinct(), "pf", "left_anti").join(cur.select(F.col("k").alias("pk")), "pk", "left_anti")
    return moved.unionByName(gone.select(F.col("pk").alias("key"), F.lit("gone").alias("change")))


def first_match(df: DataFrame, ref: DataFrame, tries: list[tuple[Column, str]], value: str, order: str, name: str) -> DataFrame:
    """The first of several equi-joins that finds something, in the order of ``tries``; least ``order`` wins in each."""
    out, got = df, []
    for i, (left, right) in enumerate(tries):
        r = ref.where(F.col(right).isNotNull()).groupBy(F.col(right).alias(f"__r{i}")).agg(F.min_by(value, order).alias(f"__v{i}"))
        out = out.withColumn(f"__l{i}", left).join(r, F.col(f"__l{i}") == F.col(f"__r{i}"), "left")
        got.append(F.col(f"__v{i}"))
    drop = [f"__{x}{i}" for i in range(len(tries)) for x in "lrv"]
    return out.withColumn(name, F.coalesce(*got)).drop(*drop)


def prefix_match(df: DataFrame, ref: DataFrame, *, left: str, right: str, length: int, name: str) -> DataFrame:
    """Adds the least value of ``right``, of at least ``length`` signs, that begins ``left`` or is begun by it.

    A prefix test as an equi-join: each value is cut at the lengths that occur on the other side.
    """
    r = ref.select(F.col(right).alias("__r")).where(F.length("__r") >= length).distinct()
    le = df.select(F.col(left).alias("__l")).where(F.col(left).isNotNull()).distinct()
    down = _prefixes(le, "__l", r, "__r").join(r, "__r").select("__l", "__r")
    up = _prefixes(r, "__r", le, "__l").join(le, "__l").select("__l", "__r")
    best = down.unionByName(up).groupBy("__l").agg(F.min("__r").alias(name))
    return df.join(best, F.col(left) == F.col("__l"), "left").drop("__l")


def _prefixes(df: DataFrame, c: str, other: DataFrame, name: str) -> DataFrame:
    """(c, name): the prefixes of ``c`` of each length that occurs in column ``name`` of ``other``.

    The lengths, no more than the longest value has signs, come as one row.
    """
    sizes = other.select(F.length(name).alias("__n")).agg(F.collect_set("__n").alias("__at"))
    cuts = df.crossJoin(F.broadcast(sizes)).select(c, F.explode(F.filter("__at", lambda n: n <= F.length(c))).alias("__n"))
    return cuts.select(c, F.substr(F.col(c), F.lit(1), F.col("__n")).alias(name))


def cascade_match(df: DataFrame, ref: DataFrame, *, left: str, right: str, length: int, name: str) -> DataFrame:
    """Adds the value of ``right`` that equals ``left``, else the least with its basename, else the least by :func:`prefix_match`.

    ``length`` holds for the prefixes only. A value that ends with a slash has no basename.
    """
    base = lambda c: F.nullif(F.substring_index(c, "/", -1), F.lit(""))
    r = ref.select(F.col(right).alias("__right"), base(F.col(right)).alias("__base")).where(F.col("__right").isNotNull()).distinct()
    near = first_match(df, r, [(F.col(left), "__right"), (base(F.col(left)), "__base")], "__right", "__right", "__near")
    rest = near.withColumn("__rest", F.when(F.col("__near").isNull(), F.col(left)))
    far = prefix_match(rest, r, left="__rest", right="__right", length=length, name="__far")
    return far.withColumn(name, F.coalesce("__near", "__far")).drop("__near", "__rest", "__far")


def all_match(df: DataFrame, *, group: str, matched: Column) -> DataFrame:
    """(group, all_matched): whether every row of a group matches; a null counts as no."""
    return df.groupBy(group).agg(F.bool_and(F.coalesce(matched, F.lit(False))).alias("all_matched"))


def supplement(main: DataFrame, more: DataFrame, key: str) -> DataFrame:
    """Rows of ``main`` and those of ``more`` whose key it lacks."""
    return main.unionByName(more.join(main.select(key).distinct(), key, "left_anti").select(*main.columns))


def carry_forward(cur: DataFrame, prev: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Current values win, missing ones come from before, and rows of either side survive."""
    p = prev.select(F.col(key).alias("__k"), *[F.col(f).alias(f"__{f}") for f in fields])
    both = cur.select(key, *fields).join(p, F.col(key) == F.col("__k"), "full_outer")
    return both.select(F.coalesce(key, "__k").alias(key), *[F.coalesce(f, f"__{f}").alias(f) for f in fields])


def pool_merge(pool: DataFrame, fresh: DataFrame, *, key: str, history: str, order: list[str], most_new: int) -> DataFrame:
    """(key, state): kept rows; vanished ones only if they have history; at most ``most_new`` new ones, in order.

    The limit is the operator's feature: a top-k over the new rows.
    """
    p = pool.select(key, F.coalesce(history, F.lit(0)).alias("__h"))
    f = fresh.select(key).distinct()
    kept = p.join(f, key, "left_semi").select(key, F.lit("kept").alias("state"))
    vanished = p.join(f, key, "left_anti").where("__h > 0").select(key, F.lit("vanished").alias("state"))
    new = fresh.join(pool.select(key), key, "left_anti").dropDuplicates([key]).orderBy(*order).limit(most_new).select(key, F.lit("new").alias("state"))
    return kept.unionByName(vanished).unionByName(new)


def reconcile(expected: DataFrame, actual: DataFrame, *, key: str, hash: str) -> DataFrame:
    """(key, verdict): ok, mismatch, missing (not in ``actual``), extra, or unread (there but without a hash)."""
    a = actual.select(F.col(key).alias("__k"), F.col(hash).alias("__a"))
    both = expected.select(F.col(key), F.col(hash).alias("__e")).join(a, F.col(key) == F.col("__k"), "full_outer")
    verdict = F.when(F.col("__k").isNull(), "missing").when(F.col(key).isNull(), "extra").when(F.col("__a").isNull(), "unread").when(F.col("__e") == F.col("__a"), "ok").otherwise("mismatch")
    return both.select(F.coalesce(key, "__k").alias(key), verdict.alias("verdict"))


def improve_only(cur: DataFrame, new: DataFrame, *, key: str, rank: str) -> DataFrame:
    """Upsert in which a rank (less is better) only improves: (key, rank)."""
    n = new.groupBy(F.col(key).alias("__k")).agg(F.min(rank).alias("__r"))
    both = cur.join(n, F.col(key) == F.col("__k"), "full_outer")
    return both.select(F.coalesce(key, "__k").alias(key), F.least(rank, "__r").alias(rank))


def upsert_levels(entries: DataFrame, rows: DataFrame, *, name: str, address: str, day: str, level: str, best: list[str]) -> DataFrame:
    """(name, address, day, level): an entry's levels by day after a day's results are merged in.

    A result belongs to the entry with its address, else to the entry of its name that has no address yet, else it makes a new
    one, named by its address where the name is taken or blank. A day's level is replaced only by a better one (by place in ``best``; levels not in it are worst, and of two of those
    the newer result stands). ``entries`` has one row an entry and day; results of one entry and day count by their best.
    """
    place = lambda c: F.coalesce(F.array_position(F.array(*[F.lit(b) for b in best]), F.col(c)).cast("int"), F.lit(0))
    rank = lambda c: F.when(place(c) > 0, place(c)).otherwise(len(best) + 1)
    known = entries.groupBy(F.col(address).alias("__a")).agg(F.min(name).alias("__by_address")).where("__a is not null")
    named = entries.where(F.col(name).isNotNull()).groupBy(F.col(name).alias("__n")).agg(F.max(F.col(address).isNotNull()).alias("__has"))
    r = rows.select(F.col(name).alias("rn"), F.col(address).alias("ra"), F.col(day).alias("rd"), F.col(level).alias("rl"))
    r = r.join(known, F.col("ra") == F.col("__a"), "left").join(named, F.col("rn") == F.col("__n"), "left")
    target = F.coalesce("__by_address", F.when(F.col("__has"), F.col("ra")), F.nullif("rn", F.lit("")), "ra")
    news = r.select(target.alias(name), F.col("ra").alias("ra"), F.col("rd").alias(day), F.col("rl").alias("rl")).where(F.col(name).isNotNull())
    news = news.groupBy(name, day).agg(F.min(F.struct(rank("rl").alias("k"), F.col("rl").alias("l"))).alias("__new"), F.min("ra").alias("ra"))
    merged = entries.select(name, address, day, level).join(news, [name, day], "full_outer")
    better = F.col("__new.k") < rank(level)
    worst = (F.col("__new.k") == len(best) + 1) & (rank(level) == len(best) + 1)
    return merged.select(name, F.coalesce(address, "ra").alias(address), day, F.when(F.col("__new").isNotNull() & (F.col(level).isNull() | better | worst), F.col("__new.l")).otherwise(F.col(level)).alias(level))


def ledger_resolve(df: DataFrame, ledger: DataFrame, *, ref: str, url: str, local: str, name: str) -> DataFrame:
    """Adds the local file of a reference from a ledger (url, local), or null.

    Tried in this order: the reference as written, without a mirror prefix and checksum, and as a relative path. What isn't in
    the ledger, such as a live endpoint, is no file. Of several entries the least file counts.
    """
    from heddle.functions.urls import bare_ref, path_norm

    r = ledger.select(F.col(url).alias("__url"), F.col(local).alias("__file"), path_norm(F.col(local)).alias("__path"))
    relative = F.when(~F.col(ref).rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), F.nullif(path_norm(bare_ref(F.col(ref))), F.lit("")))
    return first_match(df, r, [(F.col(ref), "__url"), (bare_ref(F.col(ref)), "__url"), (relative, "__path")], "__file", "__file", name)


def unfinished(jobs: DataFrame, lines: DataFrame, *, key: str, line: str, field: str) -> DataFrame:
    """Jobs without a parsable result line; garbage lines are ignored."""
    done = lines.select(F.get_json_object(F.when(F.try_parse_json(line).isNotNull(), F.col(line)), f"$.{field}").alias("__done")).where("__done is not null").distinct()
    return jobs.join(done, F.col(key).cast("string") == F.col("__done"), "left_anti")


def reuse_split(todo: DataFrame, done: DataFrame, *, key: str, at: str, ok: str, as_of: str, hours: int = 24) -> DataFrame:
    """(key, action): reuse what was found good within ``hours`` before ``as_of``, else probe."""
    d = done.groupBy(F.col(key).alias("__k")).agg(F.max(F.when(F.col(ok), F.col(at))).alias("__at"))
    fresh = F.col("__at") > F.lit(as_of).cast("timestamp") - F.make_dt_interval(F.lit(0), F.lit(hours))
    return todo.select(key).distinct().join(d, F.col(key) == F.col("__k"), "left").select(key, F.when(fresh, "reuse").otherwise("probe").alias("action"))


def follow(edges: DataFrame, *, src: str, dst: str, most: int = 8) -> DataFrame:
    """(src, dst, depth): where chains lead, each place once at its least depth, up to ``most`` steps; loops stop."""
    from heddle.runtime import durable

    e = durable(edges.select(F.col(src).alias("s"), F.col(dst).alias("t")).where("s <> t").distinct())
    seen = e.select(F.col("s").alias("src"), F.col("t").alias("dst"), F.lit(1).alias("depth"))
    front = seen
    for depth in range(2, most + 1):
        step = front.join(e, F.col("dst") == F.col("s")).select("src", F.col("t").alias("dst"), F.lit(depth).alias("depth")).where("src <> dst").distinct()
        front = durable(step.join(seen.select("src", "dst"), ["src", "dst"], "left_anti"))
        if front.isEmpty():
            break
        seen = durable(seen.unionByName(front))
    return seen


def symmetric_fields(a: Column, b: Column) -> Column:
    """Names in just one of two arrays, sorted."""
    return F.array_sort(F.array_union(F.array_except(a, b), F.array_except(b, a)))


def symmetric_count(a: DataFrame, b: DataFrame, *, by: str, item: str) -> DataFrame:
    """(by, n): for each group how many items just one of two tables has. Items are flagged and counted, never collected."""
    tagged = a.select(by, item, F.lit(1).alias("__s")).unionByName(b.select(by, item, F.lit(2).alias("__s")))
    sides = tagged.groupBy(by, item).agg(F.bit_or("__s").alias("__s"))
    return sides.groupBy(by).agg(F.count_if(F.col("__s") != 3).alias("n"))


def top_per(df: DataFrame, by: list[str], order: list[Column], k: int) -> DataFrame:
    """At most ``k`` rows of each group; a group limit before the shuffle keeps hot groups small."""
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("__n") <= k).drop("__n")
