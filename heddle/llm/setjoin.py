"""All pairs of set-valued records whose sets overlap above a Jaccard threshold.

Sets of equal type and content are first made one class; classes are joined by :mod:`heddle.operators.overlap`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heddle.operators.blocks import block_pairs
from heddle.operators.overlap import set_classes as class_sets
from heddle.operators.overlap import similar_classes
from heddle.runtime import durable, hot_lookup

#: White space that may stand around an entry.
_BLANK = " \t\n\r\f\v\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"


def entries(column: str) -> Column:
    """The entries trimmed and in lower case, without null and blank ones; null for a null array."""
    clean = F.transform(F.col(column), lambda x: F.lower(F.trim(x, F.lit(_BLANK))))
    return F.filter(clean, lambda x: x.isNotNull() & (x != ""))


def set_classes(df: DataFrame, *, id: str, type: str, values: str, least: int) -> tuple[DataFrame, DataFrame]:
    """Members (id, cls) and classes; records with a null id or type, or fewer than ``least`` entries, are left out."""
    rows = df.select(F.col(id).alias("id"), F.col(type).alias("type"), entries(values).alias("set"))
    members, classes = class_sets(rows.where(F.col("id").isNotNull() & F.col("type").isNotNull()), least)
    return members.distinct(), classes


def similar_pairs(df: DataFrame, *, id: str, type: str, values: str, threshold: float, least: int = 1, most: int = 100) -> DataFrame:
    """(id_a, id_b), smaller first, for records of equal type whose sets have |common| / |all| >= threshold.

    - Entries are compared as sets: case and white space at the ends don't count, nor do null, blank and repeated entries.
    - Records with a null id or type, a null or empty array, or fewer than ``least`` entries take part in no pair.
    - An id that is repeated is one record for each different set it comes with; a record is never paired with its own id.
    - Pairs of exactly the threshold count. Very long arrays are handled whole. An empty table gives no rows.
    - Further columns are not read, whatever their names.
    """
    members, classes = set_classes(df, id=id, type=type, values=values, least=least)
    links = durable(similar_classes(classes, threshold, most=most))
    one = members.select(F.col("cls").alias("a"), F.col("id").alias("x"))
    two = members.select(F.col("cls").alias("b"), F.col("id").alias("y"))
    across = links.select("a", "b").join(one, "a").join(two, "b").select("x", "y")
    shared = durable(classes.where(F.col("copies") > 1).select("cls", "copies"))
    copies = hot_lookup(members, shared, ["cls"], "copies").where(F.col("copies").isNotNull())
    inside = block_pairs(copies, key=["cls"], item="id", count="copies", most=1000).select(F.col("a").alias("x"), F.col("b").alias("y"))
    every = across.unionByName(inside).where("x <> y")
    return every.select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b")).distinct()


def similar_counts(df: DataFrame, *, id: str, type: str, values: str, threshold: float, least: int = 1, most: int = 100) -> DataFrame:
    """(id, class_id, links): for each record its class of equal sets and how many records its set is similar to.

    The same rules as :func:`similar_pairs`, without writing out pairs; ``class_id`` is the smallest id of the class.
    """
    members, classes = set_classes(df, id=id, type=type, values=values, least=least)
    links = durable(similar_classes(classes, threshold, most=most))
    copies = classes.select("cls", "copies")
    ends = links.select(F.col("a").alias("cls"), F.col("b").alias("far")).unionByName(links.select(F.col("b").alias("cls"), F.col("a").alias("far")))
    near = ends.join(copies.select(F.col("cls").alias("far"), "copies"), "far").groupBy("cls").agg(F.sum("copies").alias("others"))
    names = members.groupBy("cls").agg(F.min("id").alias("class_id"))
    per = names.join(copies, "cls").join(near, "cls", "left").select("cls", "class_id", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("links"), F.col("copies").alias("n"))
    return hot_lookup(members, durable(per), ["cls"], "n").select("id", "class_id", "links")
