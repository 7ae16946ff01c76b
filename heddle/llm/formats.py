"""Records that differ only in formatting, found by dictionary-encoding their columns.

Each distinct spelling of a column is canonicalised once, in a dictionary that gives it the integer of its canonical form.
Records are rewritten as sorted (field, integer) tuples by looking their values up there, and equal tuples are grouped. The
integers are hashes of (field, canonical form), so that an executor that recomputes part of the dictionary gives the same
ones; a second, independent hash checks that no two forms share one, and if any do they are told apart by another seed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heddle.runtime import durable, hot_lookup

_NOT_SIGN = r"[^\p{L}\p{N}]+"


def plain_form(c: Column) -> Column:
    """Letters and digits only, in one case; null is empty."""
    return F.coalesce(F.lower(F.upper(F.regexp_replace(c, _NOT_SIGN, ""))), F.lit(""))


def address_form(c: Column) -> Column:
    """Like :func:`plain_form`, but what follows the first ? is a set of parameters: sorted, empty ones dropped."""
    at = F.locate("?", c)
    query = F.when(at > 0, F.substr(c, at + 1)).otherwise(F.lit(""))
    params = F.array_sort(F.filter(F.transform(F.split(query, "&"), plain_form), lambda x: x != ""))
    base = plain_form(F.when(at > 0, F.substr(c, F.lit(1), at - 1)).otherwise(c))
    return F.concat(base, F.lit("?"), F.array_join(params, "&"))


def build_dictionary(df: DataFrame, fields: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """(field, raw, code, uses): each distinct value of each field with the integer of its canonical form.

    ``field`` is the place of the column in ``fields``. Null values are not in it.
    """
    cells = F.explode(F.array(*[F.struct(F.lit(i).cast("tinyint").alias("field"), F.col(c).cast("string").alias("raw")) for i, c in enumerate(fields)]))
    counts = df.select(cells.alias("c")).select("c.*").where(F.col("raw").isNotNull()).groupBy("field", "raw").agg(F.count(F.lit(1)).alias("uses"))
    form = F.lit(None).cast("string")
    for i, make in enumerate(fields.values()):
        form = F.when(F.col("field") == i, make(F.col("raw"))).otherwise(form)
    forms = counts.withColumn("form", form)
    # 0 stands for the empty form, which null has too.
    code = F.when(F.col("form").isin("", "?"), F.lit(0)).otherwise(F.xxhash64("field", "form"))
    coded = durable(forms.select("field", "raw", "uses", code.alias("code"), F.xxhash64(F.lit("check"), "form", F.lit("check")).alias("check")))
    clash = coded.groupBy("field", "code").agg(F.min("check").alias("lo"), F.max("check").alias("hi")).where((F.col("lo") != F.col("hi")) & (F.col("code") != 0))
    clash = clash.select("field", "code", "lo").limit(10_001).collect()
    if not clash:
        return coded.drop("check")
    # Forms that share a code with another: 2^-64 for a pair, so a handful even among billions. Their second hash decides.
    if len(clash) > 10_000:
        raise RuntimeError("the hash is broken: too many canonical forms share a code")
    shared = F.broadcast(coded.sparkSession.createDataFrame(clash, "field tinyint, code long, lo long"))
    return coded.join(shared, ["field", "code"], "left").select("field", "raw", "uses", F.when(F.col("lo").isNotNull() & (F.col("check") != F.col("lo")), F.col("check")).otherwise(F.col("code")).alias("code"))


def encode(df: DataFrame, *, id: str, fields: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """(id, tuple): each record as its sorted (field, code) tuple; values with the empty form are not in it.

    One shuffle brings values to the dictionary, hot values staying where they are; one brings a record's codes together.
    """
    words = build_dictionary(df, fields)
    rec = F.xxhash64(F.col(id), *[x for c in fields for x in (F.col(c).isNull(), F.col(c).cast("string"))])
    cells = F.explode(F.array(*[F.struct(F.lit(i).cast("tinyint").alias("field"), F.col(c).cast("string").alias("raw")) for i, c in enumerate(fields)]))
    melted = df.select(F.col(id).alias("id"), rec.alias("rec"), cells.alias("c")).select("id", "rec", "c.field", "c.raw").where(F.col("id").isNotNull())
    coded = hot_lookup(melted.where(F.col("raw").isNotNull()), words, ["field", "raw"], "uses").select("id", "rec", "field", "code")
    bare = melted.where(F.col("raw").isNull()).select("id", "rec", "field", F.lit(0).cast("long").alias("code"))
    # A maximum for each field keeps the aggregate in fixed-size buffers; a record has one value a field.
    codes = [F.max(F.when(F.col("field") == i, F.col("code"))).alias(f"f{i}") for i in range(len(fields))]
    wide = coded.unionByName(bare).groupBy("id", "rec").agg(*codes)
    pairs = F.array(*[F.struct(F.lit(i).cast("tinyint").alias("field"), F.coalesce(f"f{i}", F.lit(0)).alias("code")) for i in range(len(fields))])
    return wide.select("id", F.array_sort(F.filter(pairs, lambda p: p["code"] != 0)).alias("tuple"))


def format_groups(df: DataFrame, *, id: str, fields: dict[str, Callable[[Column], Column]]) -> tuple[DataFrame, DataFrame]:
    """Members (id, tuple) and groups (tuple, first_id, copies) of records that differ only in formatting.

    - Null counts as the empty text; a record whose fields all have the empty form is like any other.
    - Records with a null id are left out. Repeated rows with one id are one record; an id with several contents is one
      record for each of them.
    - Very long texts are canonicalised whole. Empty tables give no rows. Further columns are not read.
    """
    members = durable(encode(df, id=id, fields=fields))
    groups = members.groupBy("tuple").agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
    return members, durable(groups)


def format_copies(df: DataFrame, *, id: str, fields: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """(first_id, copy_id) for each record but the first of its group; the rules are those of :func:`format_groups`."""
    members, groups = format_groups(df, id=id, fields=fields)
    found = hot_lookup(members, groups.where("copies > 1"), ["tuple"], "copies")
    return found.where(F.col("first_id").isNotNull() & (F.col("id") != F.col("first_id"))).select("first_id", F.col("id").alias("copy_id"))


def format_firsts(df: DataFrame, *, id: str, fields: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """(id, first_id) for every record that has copies: the smallest id of its group, which is its own for the first of them."""
    members, groups = format_groups(df, id=id, fields=fields)
    return hot_lookup(members, groups.where("copies > 1"), ["tuple"], "copies").where(F.col("first_id").isNotNull()).select("id", "first_id")


def collapse_formats(df: DataFrame, *, id: str, fields: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """(first_id, copies): each record once, with the number of its copies, itself included."""
    return format_groups(df, id=id, fields=fields)[1].select("first_id", "copies")
