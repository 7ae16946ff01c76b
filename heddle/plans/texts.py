"""Queries for line formats and JSON: playlists built from the tables are parsed, carried, merged and written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heddle.operators import history
from heddle.sources import documents, playlist
from heddle.runtime import table


def _lines(spark: SparkSession, d: str) -> DataFrame:
    """A playlist line for each live entry: group headers, channel headers, addresses and name,address lines."""
    t = table(spark, d, "lives").select("live_id", "src", "group_name", F.regexp_replace(F.coalesce("name", F.lit("-")), r"[,\s]+", " ").alias("name"), F.regexp_replace(F.coalesce("url", F.lit("")), r"[,\s]+", "#").alias("url"))
    k = F.col("live_id") % 5
    line = (
        F.when(k == 0, F.concat(F.coalesce("group_name", F.lit("")), F.lit(",#genre#")))
        .when(k == 1, F.concat(F.lit('#EXTINF:-1 group-title="'), F.coalesce("group_name", F.lit("")), F.lit('",'), "name"))
        .when(k == 2, F.concat(F.lit("#EXTINF:-1,"), "name"))
        .when(k == 3, F.col("url"))
        .otherwise(F.concat("name", F.lit(","), "url"))
    )
    return t.select("src", "live_id", line.alias("line"))


def header_carry(spark: SparkSession, d: str) -> DataFrame:
    """What each line carries forward: the last channel header, else nothing."""
    rows = history.carry(_lines(spark, d), by=["src"], order="live_id", state=F.when(F.col("line").startswith("#EXTINF"), F.struct("line")), name="s")
    return rows.select("live_id", F.coalesce("s.line", F.lit("")).alias("head"))


def playlist_channels(spark: SparkSession, d: str) -> DataFrame:
    return playlist.parse_lines(_lines(spark, d), by=["src"], order="live_id", line="line").select("src", "live_id", "pos", "name", "group_name", "url")


def playlist_urls(spark: SparkSession, d: str) -> DataFrame:
    return playlist.collect_urls(playlist_channels(spark, d), order=["live_id", "pos"]).select("url", F.col("first.live_id").alias("first_id"))


def channel_merge(spark: SparkSession, d: str) -> DataFrame:
    c = playlist_channels(spark, d)
    m = playlist.merge_channels(c, key=F.lower("name"), name="name", url="url", order=["live_id", "pos"])
    return m.select("key", "name", F.size("urls").alias("n"), F.array_join("urls", "\n").alias("urls"))


def json_references(spark: SparkSession, d: str) -> DataFrame:
    return documents.json_urls(table(spark, d, "sites"), id="row_id", column="ext")


QUERIES = {f.__name__: f for f in (header_carry, playlist_channels, playlist_urls, channel_merge, json_references)}

_LINES = """l AS (SELECT live_id, src, CASE live_id % 5 WHEN 0 THEN coalesce(group_name, '') || ',#genre#' WHEN 1 THEN '#EXTINF:-1 group-title="' || coalesce(group_name, '') || '",' || n WHEN 2 THEN '#EXTINF:-1,' || n WHEN 3 THEN u ELSE n || ',' || u END AS line
  FROM (SELECT *, regexp_replace(coalesce(name, '-'), '[,\\s]+', ' ', 'g') AS n, regexp_replace(coalesce(url, ''), '[,\\s]+', '#', 'g') AS u FROM lives))"""
_CHANNELS = (
    _LINES
    + """, t AS (SELECT *, regexp_replace(line, '^ +| +$', '', 'g') AS t FROM l),
  s AS (SELECT *, CASE WHEN starts_with(t, '#EXTINF') THEN {'n': trim(regexp_extract(t, ',([^,]*)$', 1)), 'g': regexp_extract(t, 'group-title="([^"]*)"', 1)}
    WHEN regexp_matches(t, ',\\s*#genre#\\s*$') THEN {'n': '', 'g': trim(regexp_extract(t, '^(.*?),\\s*#genre#', 1))} END AS new FROM t),
  c AS (SELECT *, last_value(new IGNORE NULLS) OVER (PARTITION BY src ORDER BY live_id ROWS UNBOUNDED PRECEDING) AS st FROM s),
  k AS (SELECT src, live_id, t, coalesce(st.n, '') AS pn, coalesce(st.g, '') AS g, regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.\\-]*://') AND coalesce(st.n, '') <> '' AS bare,
    NOT starts_with(t, '#') AND coalesce(st.n, '') = '' AND regexp_matches(t, '^[^,]+,\\s*[A-Za-z][A-Za-z0-9+.\\-]*://') AND NOT regexp_matches(t, ',\\s*#genre#\\s*$') AS pair FROM c),
  u AS (SELECT src, live_id, CASE WHEN bare THEN pn ELSE trim(regexp_extract(t, '^([^,]+),', 1)) END AS name, g AS group_name,
    CASE WHEN bare THEN [t] ELSE list_filter(string_split(regexp_extract(t, '^[^,]+,(.*)$', 1), '#'), lambda x: regexp_matches(trim(x), '^[A-Za-z][A-Za-z0-9+.\\-]*://')) END AS urls FROM k WHERE bare OR pair),
  ch AS (SELECT src, live_id, unnest(range(len(urls)))::INT AS pos, name, group_name, trim(unnest(urls)) AS url FROM u)"""
)
SQL = {
    "header_carry": f"WITH {_LINES} SELECT live_id, coalesce(last_value(CASE WHEN starts_with(line, '#EXTINF') THEN line END IGNORE NULLS) OVER (PARTITION BY src ORDER BY live_id ROWS UNBOUNDED PRECEDING), '') AS head FROM l",
    "playlist_channels": f"WITH {_CHANNELS} SELECT * FROM ch",
    "playlist_urls": f"WITH {_CHANNELS} SELECT url, min(live_id) AS first_id FROM ch GROUP BY 1",
    "channel_merge": f"""WITH {_CHANNELS}, f AS (SELECT lower(name) AS key, url, min((live_id, pos)) AS o, arg_min(name, (live_id, pos)) AS n FROM ch GROUP BY 1, 2)
      SELECT key, arg_min(n, o) AS name, count(*)::INT AS n, array_to_string(list(url ORDER BY o), chr(10)) AS urls FROM f GROUP BY 1""",
    "json_references": """SELECT row_id AS id, replace(fullkey, '"', '') AS json_path, atom->>'$' AS url FROM (SELECT row_id, ext FROM sites WHERE json_valid(ext)) s, LATERAL (SELECT * FROM json_tree(s.ext)) t WHERE t.type = 'VARCHAR' AND regexp_matches(atom->>'$', '^https?://')""",
}
