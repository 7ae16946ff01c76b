"""Playlists: parsing M3U and TXT lines into channels, collecting their addresses, writing them back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from heddle.operators.history import carry

#: Line ends as text tools see them, not only the newline.
LINE_ENDS = "\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"
_URL = r"^[A-Za-z][A-Za-z0-9+.\-]*://"


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """(file, text) of whole files; bytes that are no UTF-8 are replaced by the reader."""
    return spark.read.text(path, wholetext=True, recursiveFileLookup=True).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("text"))


def parse_lines(lines: DataFrame, *, by: list[str], order: str, line: str) -> DataFrame:
    """(by, order, pos, name, group_name, url) from playlist lines.

    ``#EXTINF`` sets name and group (an absent group-title resets the group). ``group,#genre#`` sets the group and clears
    the name. A line that is an address takes the pending name; several addresses take the same one. ``name,address`` counts
    only while no name is pending, and its addresses may be joined by #. Other lines are skipped. The state is carried as
    one struct, since its parts are set and cleared together.
    """
    t = F.trim(F.coalesce(line, F.lit("")))
    info = t.startswith("#EXTINF")
    genre = t.rlike(r",\s*#genre#\s*$")
    name = F.trim(F.regexp_extract(t, r",([^,]*)$", 1))
    group = F.regexp_extract(t, r'group-title="([^"]*)"', 1)
    empty = F.lit("")
    new = F.when(info, F.struct(name.alias("name"), group.alias("grp"))).when(genre, F.struct(empty.alias("name"), F.trim(F.regexp_extract(t, r"^(.*?),\s*#genre#", 1)).alias("grp")))
    rows = carry(lines.withColumn("__t", t), by=by, order=order, state=new, name="__s")
    pending = F.coalesce("__s.name", empty)
    bare = F.col("__t").rlike(_URL) & (pending != "")
    pair = ~F.col("__t").rlike("^#") & (pending == "") & F.col("__t").rlike(r"^[^,]+,\s*[A-Za-z][A-Za-z0-9+.\-]*://") & ~genre
    urls = F.when(bare, F.array("__t")).when(pair, F.filter(F.split(F.regexp_extract("__t", r"^[^,]+,(.*)$", 1), "#"), lambda u: F.trim(u).rlike(_URL)))
    shown = F.when(bare, pending).otherwise(F.trim(F.regexp_extract("__t", r"^([^,]+),", 1)))
    return rows.where(bare | pair).select(*by, order, shown.alias("name"), F.coalesce("__s.grp", empty).alias("group_name"), F.posexplode(urls).alias("pos", "url")).withColumn("url", F.trim("url"))


def parse_playlists(texts: DataFrame, *, file: str = "file", text: str = "text") -> DataFrame:
    """(file, line_no, pos, name, group_name, url) of whole playlist texts."""
    lines = texts.select(file, F.posexplode(F.split(F.coalesce(text, F.lit("")), LINE_ENDS)).alias("line_no", "line"))
    return parse_lines(lines, by=[file], order="line_no", line="line")


def collect_urls(channels: DataFrame, *, order: list[str]) -> DataFrame:
    """(url, first): each address once with where it was first seen."""
    return channels.groupBy("url").agg(F.min(F.struct(*order)).alias("first"))


def merge_channels(channels: DataFrame, *, key: Column, name: str, url: str, order: list[str]) -> DataFrame:
    """(key, name, urls): channels of one key with their distinct addresses in order and the first written name.

    Addresses are made distinct before they are brought together, so only distinct ones count in a key's array.
    """
    first = channels.select(key.alias("key"), F.col(name).alias("n"), F.col(url).alias("u"), F.struct(*order).alias("o")).groupBy("key", "u").agg(F.min("o").alias("o"), F.min_by("n", "o").alias("n"))
    return first.groupBy("key").agg(F.min_by("n", "o").alias("name"), F.transform(F.array_sort(F.collect_list(F.struct("o", "u"))), lambda x: x["u"]).alias("urls"))


def m3u_lines(df: DataFrame, *, name: str, group: str, url: str, speed: str) -> DataFrame:
    """(value) text lines of a playlist: each address once, fastest first; write with ``write.text``."""
    best = df.groupBy(url).agg(F.min_by(F.struct(name, group, speed), F.coalesce(speed, F.lit(1 << 30))).alias("r"))
    line = F.concat(F.lit('#EXTINF:-1 group-title="'), F.coalesce(F.col(f"r.{group}"), F.lit("")), F.lit('",'), F.coalesce(F.col(f"r.{name}"), F.lit("")), F.lit("\n"), F.col(url))
    return best.orderBy(F.coalesce(F.col(f"r.{speed}"), F.lit(1 << 30)), url).select(line.alias("value"))
