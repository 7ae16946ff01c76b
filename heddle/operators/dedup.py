"""Layers of deduplication over catalog rows. Order comes from an explicit ordinal, never from the engine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heddle.functions.names import norm_key, quality_score, upstream_tag
from heddle.functions.urls import norm_api
from heddle.operators.history import rank_in_pieces


def first_wins(df: DataFrame, keys: list[Column], order: list[str]) -> DataFrame:
    """The first row, by ``order``, of each combination of ``keys``; nulls equal nulls.

    An aggregate with partial results before the shuffle, so a key with a third of the rows moves as one row a task.
    """
    names = [f"__k{i}" for i in range(len(keys))]
    ordered = df.select(*[k.alias(n) for k, n in zip(keys, names)], F.struct(*order).alias("__o"), F.struct(*df.columns).alias("__row"))
    return ordered.groupBy(*names).agg(F.min_by("__row", "__o").alias("__row")).select("__row.*")


def collisions(df: DataFrame, canonical: Column, raw: Column) -> DataFrame:
    """(canonical, spellings, rows) for canonical values that at least two different raw spellings share."""
    pairs = df.select(canonical.alias("canonical"), F.lower(F.regexp_replace(raw, "/+$", "")).alias("raw")).where("canonical <> ''")
    counted = pairs.groupBy("canonical", "raw").agg(F.count(F.lit(1)).alias("n"))
    return counted.groupBy("canonical").agg(F.count(F.lit(1)).alias("spellings"), F.sum("n").alias("n_rows")).where("spellings >= 2")


def rename_keys(df: DataFrame, *, key: str, api: str, order: list[str]) -> DataFrame:
    """Same normalised key: an api seen before is dropped, another api gets the key with a suffix -2, -3, ...

    The first holder of a key keeps it as it was written. Normalised keys hold no hyphen, so a suffix can't be taken.
    Distinct (key, api) pairs are ranked, so the window holds apis of a key, not rows. With one whole-number column in
    ``order`` the ranks of a key are counted up over pieces of it, so a key with any number of apis is spread over tasks.
    """
    rows = df.withColumn("__nk", norm_key(F.col(key))).withColumn("__na", norm_api(F.col(api))).where("__nk <> ''")
    kept = first_wins(rows, [F.col("__nk"), F.col("__na")], order)
    if len(order) == 1 and dict(df.dtypes)[order[0]] in ("int", "bigint", "smallint"):
        ranked = rank_in_pieces(kept, by=["__nk"], order=order[0], name="__r")
    else:
        ranked = kept.withColumn("__r", F.row_number().over(Window.partitionBy("__nk").orderBy(*order)))
    return ranked.withColumn("new_key", F.when(F.col("__r") == 1, F.col(key)).otherwise(F.concat("__nk", F.lit("-"), F.col("__r").cast("string")))).drop("__nk", "__na", "__r")


def name_best(df: DataFrame, *, name: str, key: str, origin: str, searchable: str, quick: str, api: str, order: list[str]) -> DataFrame:
    """Rows of one name: several of one upstream leave the best; singles of several upstreams get their tag.

    An upstream with several rows keeps its best one without a tag even if other upstreams share the name.
    """
    tag = upstream_tag(F.col(origin), F.col(key))
    score = quality_score(F.col(name), F.col(searchable), F.col(quick), F.col(api))
    rows = df.withColumn("__tag", tag).withColumn("__score", -score)
    sizes = rows.groupBy(name, "__tag").agg(F.count(F.lit(1)).alias("__n"))
    tags = sizes.groupBy(name).agg(F.count(F.lit(1)).alias("__tags"))
    best = first_wins(rows, [F.col(name), F.col("__tag")], ["__score", *order])
    on = best.alias("b").join(sizes.alias("s"), (F.col(f"b.{name}").eqNullSafe(F.col(f"s.{name}"))) & (F.col("b.__tag") == F.col("s.__tag"))).select("b.*", "s.__n")
    out = on.alias("b").join(tags.alias("t"), F.col(f"b.{name}").eqNullSafe(F.col(f"t.{name}"))).select("b.*", "t.__tags")
    shown = F.when((F.col("__tags") > 1) & (F.col("__n") == 1), F.concat(F.coalesce(name, F.lit("")), F.lit("["), "__tag", F.lit("]"))).otherwise(F.col(name))
    return out.withColumn("shown_name", shown).drop("__tag", "__score", "__n", "__tags")


def content_groups(df: DataFrame, *, content: Column, size: Column, order: str, whole: Column | None = None) -> DataFrame:
    """(hash, copies, savable) for contents that occur more than once; savable leaves out the first one's size.

    Truncated contents (``whole`` false) are never merged.
    """
    rows = df.where(whole) if whole is not None else df
    return rows.select(F.md5(content).alias("hash"), size.alias("size"), F.col(order).alias("o")).groupBy("hash").agg(F.count(F.lit(1)).alias("copies"), (F.sum("size") - F.min_by("size", "o")).alias("savable")).where("copies > 1")


def case_collisions(df: DataFrame, *, path: str) -> DataFrame:
    """(path, new_path): of paths that differ only in case the first in byte order stays, others get a hash suffix.

    A new name that is itself taken gets another round of its hash; two rounds suffice unless md5 fails.
    """
    paths = df.select(F.col(path).alias("path")).where(F.col(path).isNotNull()).distinct().withColumn("fold", F.lower("path"))
    first = paths.groupBy("fold").agg(F.min("path").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    both = paths.join(first, "fold").where(F.col("path") != F.col("first"))
    stem, ext = F.regexp_extract("path", r"^(.*?)(\.[^./]*)?$", 1), F.regexp_extract("path", r"[^/](\.[^./]*)$", 1)
    new = F.concat(stem, F.lit("~"), F.substr(F.md5("path"), F.lit(1), F.lit(6)), ext)
    again = F.concat(stem, F.lit("~"), F.substr(F.md5(F.concat("path", F.lit("#1"))), F.lit(1), F.lit(6)), ext)
    used = paths.select(F.col("fold").alias("used"))
    made = both.select("path", new.alias("new"), again.alias("again"))
    return made.join(used, F.lower("new") == F.col("used"), "left").select("path", F.when(F.col("used").isNotNull(), F.col("again")).otherwise(F.col("new")).alias("new_path"))
