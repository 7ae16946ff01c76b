"""Queries of the general data-processing problems: snapshot changes and packed fields."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heddle.operators.packed import known_values, split_packed
from heddle.operators.snapshots import snapshot_changes
from heddle.runtime import table


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "interfaces")
    return snapshot_changes(t, date="snapshot_date", key="key", order="updated_at", compare=["health", "api"])


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    sites = table(spark, d, "sites").select(F.col("row_id").alias("id"), F.col("ext").alias("v"), F.lit("sites").alias("kind"))
    lives = table(spark, d, "lives").select(F.col("live_id").alias("id"), F.col("url").alias("v"), F.lit("lives").alias("kind"))
    api = table(spark, d, "sites").select("api")  # one address a row
    known = known_values(sites.unionByName(lives), "v", single=[api])  # one dictionary for both tables
    parts = [split_packed(t, id="id", column="v", known=known).select(F.lit(k).alias("rec_kind"), "rec_id", "pos", "item") for t, k in ((sites, "sites"), (lives, "lives"))]
    return parts[0].unionByName(parts[1])


QUERIES = {"p5_found": p5_found, "p6_found": p6_found}

_HEAD = "(?:[A-Za-z][A-Za-z0-9+.\\-]*://|\\.\\.?/)"
_APART = "[\\s,，、;；|｜#\"''“”‘’`]"

SQL = {
    # The grammar alone, without dictionary: a sign is put before each head that follows a separator, and pieces are trimmed.
    "p6_found": f"""
WITH f AS (SELECT 'sites' AS rec_kind, row_id AS rec_id, ext AS v FROM sites UNION ALL SELECT 'lives', live_id, url FROM lives),
s AS (SELECT rec_kind, rec_id, regexp_replace(v, '^\\s+|\\s+$', '', 'g') AS v FROM f WHERE v IS NOT NULL),
l AS (SELECT rec_kind, rec_id, CASE WHEN json_valid(v) AND v LIKE '[%' THEN list_filter(list_transform(from_json(v, '["VARCHAR"]'), lambda x: trim(x)), lambda x: regexp_matches(x, '^{_HEAD}'))
  WHEN json_valid(v) AND v LIKE '{{%' THEN []
  ELSE list_transform(string_split(regexp_replace(v, '(^|{_APART}|\\$\\$\\$)({_HEAD})', '\\1' || chr(1) || '\\2', 'g'), chr(1))[2:], lambda x: regexp_replace(x, '(?:{_APART}|\\$\\$\\$)+$', '')) END AS items FROM s)
SELECT rec_kind, rec_id, unnest(range(1, len(items) + 1))::INT AS pos, unnest(items) AS item FROM l WHERE len(items) >= 2
""",
    "p5_found": """
WITH r AS (
  SELECT snapshot_date, key, health, api,
         row_number() OVER (PARTITION BY snapshot_date, key ORDER BY updated_at DESC NULLS LAST) AS n
  FROM interfaces WHERE key IS NOT NULL AND regexp_matches(key, '\\S') AND snapshot_date IS NOT NULL),
d AS (SELECT snapshot_date, lag(snapshot_date) OVER (ORDER BY snapshot_date) AS prev
      FROM (SELECT DISTINCT snapshot_date FROM interfaces WHERE snapshot_date IS NOT NULL)),
now AS (SELECT r.*, d.prev FROM r JOIN d USING (snapshot_date) WHERE n = 1 AND d.prev IS NOT NULL),
was AS (SELECT d.snapshot_date, r.key, r.health, r.api FROM r JOIN d ON r.snapshot_date = d.prev WHERE n = 1)
SELECT coalesce(now.snapshot_date, was.snapshot_date) AS snapshot_date, coalesce(now.key, was.key) AS key,
       CASE WHEN was.key IS NULL THEN 'added' WHEN now.key IS NULL THEN 'removed' ELSE 'changed' END AS change_kind
FROM now FULL OUTER JOIN was ON now.snapshot_date = was.snapshot_date AND now.key = was.key
WHERE was.key IS NULL OR now.key IS NULL OR now.health IS DISTINCT FROM was.health OR now.api IS DISTINCT FROM was.api
""",
}
