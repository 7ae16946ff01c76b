"""Queries for the smaller catalog operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heddle.functions import grades
from heddle.functions.names import dated_name
from heddle.functions.urls import parse_url_norm
from heddle.operators import catalog, history, joins
from heddle.runtime import broadcast_if_small, table


def site_targets(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "sites").select("row_id", catalog.target_of(F.col("api"), F.col("ext")).alias("t")).select("row_id", "t.target", "t.source")


def static_grades(spark: SparkSession, d: str) -> DataFrame:
    g = catalog.static_grade(F.col("api").isNotNull(), F.col("l1_ok"), F.size("names"), F.col("api").startswith("http"))
    return table(spark, d, "sites_probe").groupBy(g.alias("grade")).agg(F.count(F.lit(1)).alias("n"))


def located_sites(spark: SparkSession, d: str) -> DataFrame:
    """Sites by source, each source a series of JSON documents of about a thousand pairs, so that no task holds a whole source."""
    s = table(spark, d, "sites").select("src", "key", "api")
    docs = broadcast_if_small(s.groupBy(F.col("src").alias("__src")).agg(F.ceil(F.count(F.lit(1)) / 1000).alias("docs")))
    pairs = s.distinct().join(docs, F.col("src").eqNullSafe(F.col("__src"))).withColumn("part", F.pmod(F.xxhash64("key", "api"), "docs"))
    s = pairs.groupBy("src", "part").agg(F.to_json(F.struct(F.collect_list(F.struct("key", "api")).alias("sites"))).alias("doc"))
    n = F.coalesce(F.size(catalog.locate_sites(F.col("doc"))), F.raise_error(F.lit("a document of sites cannot be read")))
    return s.groupBy("src").agg(F.sum(n).cast("int").alias("n"))


def preferred_blobs(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "documents").select("source", F.concat("doc_id", F.when(F.col("doc_id") % 3 == 0, ".md").otherwise(".json")).alias("path"), F.col("n_chars").alias("size"))
    return catalog.prefer_blobs(t, group="source", path="path", size="size").select("source", "path", "n")


def alternate_prefixes(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "region").select(F.concat(F.lit("https://"), F.lower(F.replace("r_name", F.lit(" "), F.lit("-"))), F.lit(".example/")).alias("p"))
    t = table(spark, d, "lives").where("health = 'dead' and url like 'http%'").select("url", F.when(F.col("channels") > 5, "timeout").otherwise("404").alias("why")).distinct()
    return catalog.alternates(t, p, url="url", prefix="p", failure="why", environment=["timeout"])


def rewritten_jars(spark: SparkSession, d: str) -> DataFrame:
    """References of three fields in one, two of them with a local name; the source, and a jar of even length, failed."""
    jar, key = F.concat(F.lit("j:"), "jar"), F.concat(F.lit("k:"), F.coalesce("key", F.lit("")))
    local = F.create_map(jar, F.concat(F.lit("local/"), F.substr(F.md5("jar"), F.lit(1), F.lit(6))), key, F.concat(F.lit("keys/"), F.length("key")))
    t = table(spark, d, "sites").where("jar <> ''")
    chain = F.concat_ws("$$$", jar, key, "src", F.lit("own.jar"))
    failed = F.array_compact(F.array(F.col("src"), F.when(F.length("jar") % 2 == 0, jar)))
    return t.select("row_id", catalog.rewrite_segments(chain, local, failed).alias("refs"))


def inlined_rules(spark: SparkSession, d: str) -> DataFrame:
    """Parts of a field replaced by what they stand for: the name and the health of the entry; its source stands for nothing."""
    text = lambda c: F.coalesce(c, F.lit(""))
    m = F.create_map(F.concat(F.lit("n:"), "live_id"), text("name"), F.concat(F.lit("h:"), text("group_name")), text("health"))
    field = F.concat_ws("$$$", F.concat(F.lit("n:"), "live_id"), F.concat(F.lit("h:"), text("group_name")), F.col("src"))
    return table(spark, d, "lives").select("live_id", catalog.inline_segments(field, m, 3, 12).alias("s")).select("live_id", "s.text", "s.notes")


def segment_labels(spark: SparkSession, d: str) -> DataFrame:
    n = F.concat_ws("/", "group_name", F.regexp_replace(F.coalesce("name", F.lit("")), " ", "/"))
    return table(spark, d, "lives").select("live_id", catalog.segment_label(n, "TV|其他|Kids").alias("hit"))


def archive_verdicts(spark: SparkSession, d: str) -> DataFrame:
    e = F.concat(F.when(F.col("live_id") % 7 == 0, "vocab/").otherwise("x/"), "src", F.when(F.col("live_id") % 2 == 0, ".jar").otherwise(".txt"))
    return table(spark, d, "lives").groupBy(catalog.archive_verdict(e, F.coalesce("name", F.lit("")), "TV|体育|tv1", "Canal|台").alias("verdict")).agg(F.count(F.lit(1)).alias("n"))


def trusted_levels(spark: SparkSession, d: str) -> DataFrame:
    t = catalog.trusted_rows(table(spark, d, "interfaces"), level="level", evidence=F.col("fail_streak") > 0, death="S0")
    return t.groupBy("level").agg(F.count(F.lit(1)).alias("n"))


def retained_names(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "interfaces").select(F.concat(F.lit("v"), "first_seen", F.lit("-b"), F.length("key")).alias("name")).where("name is not null").distinct()
    return catalog.retention(t, t.where("name like '%1'"), name="name", day=dated_name(F.col("name")), as_of="2026-10-05", days=100)


def stream_orphans(spark: SparkSession, d: str) -> DataFrame:
    t = catalog.link_streams(table(spark, d, "lives").select(F.col("name").alias("channel")), table(spark, d, "name_vocab"), channel="channel", id="display_name")
    return t.groupBy("orphan").agg(F.count(F.lit(1)).alias("n"))


def merged_aliases(spark: SparkSession, d: str) -> DataFrame:
    v = table(spark, d, "name_vocab").select(F.lower("display_name").alias("alias"), "display_name").groupBy("alias").agg(F.max("display_name").alias("target"))
    new = table(spark, d, "lives").where("name is not null").select(F.lower("name").alias("alias"), F.col("name").alias("target"))
    return catalog.alias_merge(v, new, alias="alias", target="target")


def round_winners(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "interfaces").where("latency_ms is not null").groupBy("source", "snapshot_date").agg(F.min("latency_ms").alias("ms"))
    return catalog.round_winner(t, item="source", round="snapshot_date", value="ms", least=8)


def protected_paths(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "sites").where("jar <> ''").select(F.concat("src", F.lit("/Dep/"), F.regexp_extract("jar", r"([^/;]+)(?:;.*)?$", 1)).alias("path")).distinct()
    live = table(spark, d, "interfaces").select(F.concat(F.upper("source"), F.lit("/dep/")).alias("path")).where("path like '%BOX%'")
    return catalog.protect(c, live, path="path")


def duplicate_files(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "documents").where("text is not null").select("doc_id", "n_chars", "text")
    return catalog.two_phase_duplicates(t, path="doc_id", size="n_chars", content="text")


def rotation_actions(spark: SparkSession, d: str) -> DataFrame:
    return catalog.rotation_decide(table(spark, d, "interfaces").select("snapshot_date").distinct(), name="snapshot_date")


def artefact_ages(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "interfaces").select("snapshot_date", F.when(F.col("health") == "dead", "broken").otherwise(F.col("snapshot_date")).alias("made")).distinct()
    return t.select("snapshot_date", "made", catalog.artefact_age(F.col("made"), "2026-10-01 06:00:00").alias("hours"))


def pruned_text(spark: SparkSession, d: str) -> DataFrame:
    line = F.when(F.col("live_id") % 6 == 0, F.concat(F.coalesce("group_name", F.lit("g")), F.lit(",#genre#"))).otherwise(F.concat(F.coalesce("name", F.lit("-")), F.lit(","), F.coalesce("url", F.lit(""))))
    t = table(spark, d, "lives").select("src", "live_id", line.alias("line"), "health")
    return catalog.prune_text(t, by="src", order="live_id", line="line", dead=F.col("health") == "dead", alive=F.col("health") == "healthy").select("src", "live_id", "place")


def alerts_once(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "interfaces").groupBy(F.coalesce("health", F.lit("none")).alias("metric")).agg(F.count(F.lit(1)).alias("value")).withColumn("limit", F.lit(600))
    return catalog.alert_once(t, t.where("metric like 'd%' and value % 2 = 0"), metric="metric", value="value", limit="limit")


def layer_counts(spark: SparkSession, d: str) -> DataFrame:
    src = table(spark, d, "sites").groupBy(F.col("src").alias("name")).agg((F.count(F.lit(1)) % 5 == 0).alias("decayed"))
    lives = table(spark, d, "lives").select("live_id", "src", "name", "url")
    return catalog.layered_dedup(table(spark, d, "sites").select("row_id", "src", "key", "api", "type", "jar"), src, lives, order="row_id")


def annotated_changes(spark: SparkSession, d: str) -> DataFrame:
    t = catalog.annotate(table(spark, d, "sites").select("row_id", "key", "api", "name", "src"), key="key", api="api", name="name")
    return t.groupBy("src").agg(F.count_if("changed").alias("changed"), F.count_distinct("c_host").alias("hosts"))


def parse_ranking(spark: SparkSession, d: str) -> DataFrame:
    """Endpoints by probe status, latency and kind, looked up by normalised address."""
    status = F.element_at(F.array(*[F.lit(x) for x in ("ok", "ad_warn", "unreachable", "placeholder")]), (F.col("probe_id") % 4 + 1).cast("int"))
    p = table(spark, d, "sites_probe").groupBy(parse_url_norm(F.col("api")).alias("u")).agg(F.min_by(F.struct(status.alias("status"), "ms"), "probe_id").alias("r")).select("u", "r.*")
    s = table(spark, d, "sites").select("row_id", F.when(F.col("type") == 1, 0).otherwise(1).alias("pref"), parse_url_norm(F.col("api")).alias("u")).join(p, "u", "left")
    s = s.select("row_id", grades.mapped(F.col("status"), grades.PARSE_RANK, 2).alias("rank"), F.coalesce(F.nullif("ms", F.lit(0)), F.lit(999999)).alias("ms"), "pref")
    return s.orderBy("rank", "ms", "pref", "row_id")


def failure_rollup(spark: SparkSession, d: str) -> DataFrame:
    """How many probes fail at each stage, with the least ids as sample."""
    p = table(spark, d, "sites_probe").select("probe_id", F.array_compact(F.array(F.when(~F.coalesce("l1_ok", F.lit(False)), F.lit("l1")), F.when(F.size(F.coalesce("names", F.array())) == 0, F.lit("l2")), F.when(F.coalesce("total", F.lit(0)) == 0, F.lit("l3")))).alias("fails"))
    f = p.select("probe_id", F.explode("fails").alias("stage"))
    sample = joins.top_per(f, ["stage"], [F.asc("probe_id")], 3).groupBy("stage").agg(F.array_join(F.transform(F.array_sort(F.collect_list("probe_id")), lambda x: x.cast("string")), ",").alias("sample"))
    return f.groupBy("stage").agg(F.count(F.lit(1)).alias("n")).join(sample, "stage")


def folder_bytes(spark: SparkSession, d: str) -> DataFrame:
    """Bytes and files by the first two parts of a path, largest first."""
    t = table(spark, d, "documents").select(F.concat(F.coalesce("lang", F.lit("none")), F.lit("/"), "source", F.lit("/"), "doc_id").alias("path"), "n_chars")
    g = t.groupBy(F.substring_index("path", "/", 2).alias("folder")).agg(F.sum("n_chars").alias("bytes"), F.count(F.lit(1)).alias("files"))
    return g.orderBy(F.desc("bytes"), "folder")


def origin_counts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "sites").groupBy("origin").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("key").alias("n_keys"))


def candidate_rank(spark: SparkSession, d: str) -> DataFrame:
    """Candidates by score, catalogs before others, size and address."""
    t = table(spark, d, "sites").groupBy("origin").agg(F.count(F.lit(1)).alias("size"), F.count_distinct("type").alias("score"))
    kind = F.when(F.col("origin").endswith("index.json"), 0).otherwise(1)
    return t.withColumn("kind", kind).orderBy(F.desc("score"), "kind", F.desc("size"), "origin")


def day_rotation(spark: SparkSession, d: str) -> DataFrame:
    """The keys of day 3 of a rotation that covers all keys in ceil(n / 40) days."""
    r = history.global_rank(table(spark, d, "supplier").select("s_suppkey"), ["s_suppkey"])
    return r.where(F.col("rank").between(0, 39) if r.count() <= 40 else F.floor(F.col("rank") / 40) == 3 % -(-r.count() // 40)).select("s_suppkey")


def public_filter(spark: SparkSession, d: str) -> DataFrame:
    """Rows of which neither the listed nor the working address is on a blocked host."""
    t = table(spark, d, "sites").select("row_id", "api", "ext")
    blocked = r"://[^/]*\.invalid(/|$)"
    return t.where(~(F.coalesce("api", F.lit("")).rlike(blocked) | F.coalesce("ext", F.lit("")).rlike(blocked))).select("row_id")


_FUNCTIONS = [v for k, v in list(globals().items()) if callable(v) and getattr(v, "__module__", "") == __name__ and not k.startswith("_")]
QUERIES = {f.__name__: f for f in _FUNCTIONS}


def _sql() -> dict[str, str]:
    from heddle.plans.scalars import _U, NORMAL_NAME, _canonical
    from heddle.plans.tables import _NK

    links = lambda c: f"list_filter(list_transform(regexp_extract_all(coalesce({c}, ''), 'https?://[^\\s<>\"''()\\[\\]，。、；]+'), lambda u: regexp_replace(u, '[.,;:!?]+$', '')), lambda u: NOT regexp_matches(u, '^https?://(?:[^/]*github|[^/]*gitee|localhost|127\\.|[^/]*example\\.com)'))"
    u = _U.format("api")
    na = f"lower(CASE WHEN regexp_matches({u}, '^(?i)https?://') THEN {_canonical('api')} ELSE {u} END)"
    end = f"CASE WHEN regexp_matches({u}, '^(?i)https?://') THEN 'https://' || lower(regexp_extract(regexp_replace({u}, '^(?i)https?://', ''), '^([^/]*)', 1)) || regexp_replace(regexp_extract(regexp_replace({u}, '^(?i)https?://', ''), '(?s)^[^/]*(.*)$', 1), '/+$', '') ELSE {u} END"
    return {
        "site_targets": f"WITH t AS (SELECT row_id, {u} AS u, ({links('ext')})[1] AS e, ({links('api')})[1] AS a FROM sites) SELECT row_id, coalesce(e, a) AS target, CASE WHEN e IS NOT NULL THEN 'ext' WHEN a IS NOT NULL THEN 'api' WHEN starts_with(u, './') THEN 'no trusted address in rule' ELSE 'no address' END AS source FROM t",
        "static_grades": "SELECT CASE WHEN api IS NULL THEN 'P0' WHEN NOT coalesce(l1_ok, false) THEN 'P1' WHEN coalesce(len(names), 0) < 3 THEN 'P2' WHEN NOT starts_with(api, 'http') THEN 'P3' ELSE 'P4' END AS grade, count(*) AS n FROM sites_probe GROUP BY 1",
        "located_sites": "SELECT src, count(*)::INT AS n FROM (SELECT DISTINCT src, key, api FROM sites) GROUP BY src",
        "preferred_blobs": "SELECT source, path, n::INT AS n FROM (SELECT source, doc_id || '.json' AS path, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id || '.json') AS n FROM documents WHERE doc_id % 3 <> 0 AND n_chars BETWEEN 500 AND 12582912) WHERE n <= 8",
        "alternate_prefixes": """WITH p AS (SELECT list(DISTINCT 'https://' || lower(replace(r_name, ' ', '-')) || '.example/' ORDER BY 'https://' || lower(replace(r_name, ' ', '-')) || '.example/') AS l FROM region), t AS (SELECT DISTINCT url FROM lives WHERE health = 'dead' AND url LIKE 'http%' AND channels > 5)
          SELECT url, unnest(list_transform(list_filter(l, lambda x: NOT starts_with(url, x))[1:3], lambda x: x || regexp_replace(url, '^https?://[^/]+/(https?://)', '\\1'))) AS candidate FROM t, p""",
        "rewritten_jars": "SELECT row_id, CASE WHEN length(jar) % 2 = 1 THEN 'local/' || substr(md5(jar), 1, 6) || '$$$' ELSE '' END || CASE WHEN key IS NULL THEN 'k:' ELSE 'keys/' || length(key) END || '$$$own.jar' AS refs FROM sites WHERE jar <> ''",
        "inlined_rules": """WITH t AS (SELECT live_id, coalesce(name, '') AS n, coalesce(health, '') AS h, 'h:' || coalesce(group_name, '') AS g, src FROM lives)
          SELECT live_id, concat_ws('$$$', CASE WHEN length(n) BETWEEN 3 AND 12 THEN n ELSE 'n:' || live_id END, CASE WHEN length(h) BETWEEN 3 AND 12 THEN h ELSE g END, src) AS text,
            CASE WHEN length(n) BETWEEN 3 AND 12 THEN 'inlined' WHEN length(n) < 3 THEN 'small' ELSE 'large' END || CASE WHEN length(h) BETWEEN 3 AND 12 THEN ',inlined' WHEN length(h) < 3 THEN ',small' ELSE ',large' END || CASE WHEN src IS NULL THEN '' ELSE ',kept' END AS notes FROM t""",
        "segment_labels": "SELECT live_id, len(list_filter(string_split(concat_ws('/', group_name, replace(coalesce(name, ''), ' ', '/')), '/'), lambda s: regexp_matches(trim(s), '^(?:TV|其他|Kids)$'))) > 0 AS hit FROM lives",
        "archive_verdicts": """WITH e AS (SELECT CASE WHEN live_id % 7 = 0 THEN 'vocab/' ELSE 'x/' END || src || CASE WHEN live_id % 2 = 0 THEN '.jar' ELSE '.txt' END AS e, coalesce(name, '') AS v FROM lives), s AS (SELECT e, CASE WHEN regexp_matches(e, '\\.(jar|png|jpg|zip)$') THEN e ELSE v END AS s FROM e)
          SELECT CASE WHEN regexp_matches(e, '(^|/)vocab') THEN 'skipped' WHEN NOT regexp_matches(s, 'TV|体育|tv1') THEN 'clean' WHEN regexp_matches(s, 'Canal|台') THEN 'guarded' ELSE 'word' END AS verdict, count(*) AS n FROM s GROUP BY 1""",
        "trusted_levels": "SELECT level, count(*) AS n FROM interfaces WHERE level IS NULL OR level <> 'S0' OR coalesce(fail_streak > 0, false) GROUP BY 1",
        "retained_names": """SELECT name, CASE WHEN name LIKE '%1' OR d IS NULL OR date_diff('day', d, DATE '2026-10-05') <= 100 THEN 'keep' ELSE 'delete' END AS action FROM (SELECT DISTINCT 'v' || first_seen || '-b' || length(key) AS name, TRY_CAST(first_seen AS DATE) AS d FROM interfaces) WHERE name IS NOT NULL""",
        "stream_orphans": "SELECT v.display_name IS NULL AS orphan, count(*) AS n FROM lives LEFT JOIN (SELECT DISTINCT display_name FROM name_vocab) v ON v.display_name = lives.name GROUP BY 1",
        "merged_aliases": "WITH v AS (SELECT lower(display_name) AS alias, max(display_name) AS target FROM name_vocab GROUP BY 1) SELECT * FROM v UNION ALL SELECT lower(name), min(name) FROM lives WHERE name IS NOT NULL AND lower(name) NOT IN (SELECT alias FROM v) GROUP BY 1",
        "round_winners": "WITH m AS (SELECT source, snapshot_date, min(latency_ms) AS ms FROM interfaces WHERE latency_ms IS NOT NULL GROUP BY 1, 2) SELECT source, count(*) AS rounds, list_sort(list(ms))[(count(*) // 2 + 1)::INT] AS median FROM m GROUP BY 1 HAVING count(*) >= 8",
        "protected_paths": "SELECT DISTINCT src || '/Dep/' || regexp_extract(jar, '([^/;]+)(?:;.*)?$', 1) AS path FROM sites WHERE jar <> '' AND lower(src) NOT IN (SELECT lower(source) FROM interfaces WHERE upper(source) LIKE '%BOX%')",
        "duplicate_files": "SELECT md5(text) AS hash, min(doc_id) AS first, count(*) AS copies FROM documents WHERE text IS NOT NULL GROUP BY 1 HAVING count(*) > 1",
        "rotation_actions": "SELECT DISTINCT snapshot_date, CASE WHEN snapshot_date = (SELECT max(snapshot_date) FROM interfaces) THEN 'keep' ELSE 'untrack' END AS action FROM interfaces",
        "artefact_ages": "SELECT DISTINCT snapshot_date, made, coalesce(epoch(TIMESTAMP '2026-10-01 06:00:00' - TRY_CAST(made AS TIMESTAMP)) / 3600, 999.0) AS hours FROM (SELECT snapshot_date, CASE WHEN health = 'dead' THEN 'broken' ELSE snapshot_date END AS made FROM interfaces)",
        "pruned_text": """WITH l AS (SELECT src, live_id, live_id % 6 = 0 OR (live_id % 6 <> 0 AND regexp_matches(coalesce(name, '-') || ',' || coalesce(url, ''), ',\\s*#genre#\\s*$')) AS h, health FROM lives), b AS (SELECT *, sum(h::INT) OVER (PARTITION BY src ORDER BY live_id) AS blk FROM l),
          k AS (SELECT * FROM b WHERE h OR health IS DISTINCT FROM 'dead'), f AS (SELECT src, blk FROM k GROUP BY 1, 2 HAVING bool_or(NOT h))
          SELECT src, live_id, (row_number() OVER (PARTITION BY src, blk ORDER BY CASE WHEN h THEN 0 WHEN health = 'healthy' THEN 1 ELSE 2 END, live_id) - 1)::INT AS place FROM k JOIN f USING (src, blk)""",
        "alerts_once": "SELECT m AS metric, n > 600 AND NOT (m LIKE 'd%' AND n % 2 = 0) AS alert FROM (SELECT coalesce(health, 'none') AS m, count(*) AS n FROM interfaces GROUP BY 1)",
        "layer_counts": f"""WITH d AS (SELECT src FROM sites GROUP BY 1 HAVING count(*) % 5 = 0), l AS (SELECT * FROM sites WHERE src IS NULL OR src NOT IN (SELECT src FROM d WHERE src IS NOT NULL)), k AS (SELECT min(row_id) AS row_id FROM (SELECT row_id, {_NK} AS nk, {na} AS na FROM l) WHERE nk <> '' GROUP BY nk, na),
          f AS (SELECT min(row_id) AS row_id FROM l JOIN k USING (row_id) GROUP BY type, {na}, coalesce(jar, ''))
          SELECT 0 AS layer, 'raw' AS layer_name, count(*) AS n FROM sites UNION ALL SELECT 1, 'decay', count(*) FROM l UNION ALL SELECT 2, 'key', count(*) FROM k UNION ALL SELECT 3, 'fingerprint', count(*) FROM f
          UNION ALL SELECT 4, 'lives', count(*) FROM (SELECT DISTINCT lower(regexp_replace(coalesce(name, ''), '[^\\p{{L}}\\p{{N}}]+', '', 'g')), trim(url) FROM lives WHERE trim(coalesce(url, '')) <> '' AND (src IS NULL OR src NOT IN (SELECT src FROM d WHERE src IS NOT NULL)))""",
        "annotated_changes": f"""SELECT src, count(*) FILTER ({_NK} <> coalesce(key, '') OR {NORMAL_NAME} <> coalesce(name, '')) AS changed, count(DISTINCT lower(regexp_extract({u}, '^[A-Za-z][A-Za-z0-9+.\\-]*://(?:[^/?#@]*@)?([^/?#]*)', 1))) AS hosts FROM sites GROUP BY 1""",
        "parse_ranking": f"""WITH p AS (SELECT {end} AS u, arg_min({{'s': ['ok', 'ad_warn', 'unreachable', 'placeholder'][probe_id % 4 + 1], 'ms': ms}}, probe_id) AS r FROM sites_probe GROUP BY 1), s AS (SELECT row_id, CASE WHEN type = 1 THEN 0 ELSE 1 END AS pref, {end} AS u FROM sites)
          SELECT row_id, CASE r.s WHEN 'ok' THEN 0 WHEN 'placeholder' THEN 1 WHEN 'ad_warn' THEN 3 WHEN 'unreachable' THEN 4 ELSE 2 END AS rank, coalesce(nullif(r.ms, 0), 999999) AS ms, pref FROM s LEFT JOIN p USING (u) ORDER BY rank, ms, pref, row_id""",
        "failure_rollup": """WITH f AS (SELECT probe_id, 'l1' AS stage FROM sites_probe WHERE NOT coalesce(l1_ok, false) UNION ALL SELECT probe_id, 'l2' FROM sites_probe WHERE coalesce(len(names), 0) = 0 UNION ALL SELECT probe_id, 'l3' FROM sites_probe WHERE coalesce(total, 0) = 0)
          SELECT stage, count(*) AS n, array_to_string(list_sort(list(probe_id))[1:3], ',') AS sample FROM f GROUP BY 1""",
        "folder_bytes": "SELECT coalesce(lang, 'none') || '/' || source AS folder, sum(n_chars)::BIGINT AS bytes, count(*) AS files FROM documents GROUP BY 1 ORDER BY bytes DESC, folder",
        "origin_counts": "SELECT origin, count(*) AS n, count(DISTINCT key) AS n_keys FROM sites GROUP BY 1",
        "candidate_rank": "SELECT origin, count(*) AS size, count(DISTINCT type) AS score, CASE WHEN ends_with(origin, 'index.json') THEN 0 ELSE 1 END AS kind FROM sites GROUP BY 1 ORDER BY score DESC, kind, size DESC, origin",
        "day_rotation": "WITH n AS (SELECT count(*) AS n FROM supplier), r AS (SELECT s_suppkey, row_number() OVER (ORDER BY s_suppkey) - 1 AS r FROM supplier) SELECT s_suppkey FROM r, n WHERE CASE WHEN n <= 40 THEN r <= 39 ELSE r // 40 = 3 % ((n + 39) // 40) END",
        "public_filter": "SELECT row_id FROM sites WHERE NOT regexp_matches(coalesce(api, ''), '://[^/]*\\.invalid(/|$)') AND NOT regexp_matches(coalesce(ext, ''), '://[^/]*\\.invalid(/|$)')",
    }


SQL = _sql()
