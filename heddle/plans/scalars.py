"""Queries for the column functions: addresses, names, paths, contents, grades."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heddle.functions import content, grades, names, urls
from heddle.runtime import table

_U = "regexp_replace(coalesce({0}, ''), '^\\s+|\\s+$', '', 'g')"
_PROXY = "regexp_replace({0}, '^(?i:(?:https?://)?(?:ghproxy\\.net|gh-proxy\\.com|ghfast\\.top|mirror\\.ghproxy\\.com|ghproxy\\.com)/)+(https?://)', '\\1')"


def _canonical(c: str) -> str:
    u = f"regexp_replace({_PROXY.format(_U.format(c))}, '(?s)#.*$', '')"
    bare = f"regexp_replace({u}, '^(?i)https?://', '')"
    host = f"regexp_replace(lower(regexp_extract({bare}, '^([^/?]*)', 1)), '^www\\.', '')"
    host = f"CASE WHEN regexp_matches({u}, '^(?i)https://') THEN regexp_replace({host}, ':443$', '') ELSE regexp_replace({host}, ':80$', '') END"
    return f"(({host}) || regexp_replace(regexp_extract({bare}, '(?s)^[^/?]*(.*)$', 1), '/+$', ''))"


def canonical_url_key(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "sites").select("row_id", urls.canonical_url(F.col("api")).alias("canonical"), urls.norm_api(F.col("api")).alias("api_ci"))


def endpoint_form(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "sites").select("row_id", urls.parse_url_norm(F.col("api")).alias("endpoint"), urls.host_of(F.col("api")).alias("host"))


def name_forms(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("name")
    return table(spark, d, "lives").select("live_id", names.title_norm(n).alias("title"), names.latency_label(n).alias("latency"), names.norm_key(n).alias("key_form"), names.group_core(F.col("group_name")).alias("core"))


def tag_and_score(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "sites").select("row_id", names.upstream_tag(F.col("origin"), F.col("key")).alias("tag"), names.quality_score(F.col("name"), F.col("searchable"), F.col("quick_search"), F.col("api")).alias("score"))


def normalized_names(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lives").select("live_id", names.normalize_name(F.col("name")).alias("norm"))


def reference_paths(spark: SparkSession, d: str) -> DataFrame:
    refs = table(spark, d, "sites").select("row_id", F.posexplode(urls.split_refs(F.col("ext"))).alias("pos", "ref"))
    return refs.select("row_id", "pos", "ref", urls.path_norm(F.col("ref")).alias("path"), names.windows_reason(F.col("ref")).alias("reason"))


def bare_references(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "sites").where(F.col("jar").isNotNull()).select("row_id", urls.bare_ref(F.col("jar")).alias("bare"), urls.local_name(F.col("jar")).alias("file"))


def url_classes(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lives").groupBy(urls.url_class(F.col("url")).alias("url_class")).agg(F.count(F.lit(1)).alias("n"))


def remote_counts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "sites").select("row_id", F.size(urls.remote_list(F.col("ext"))).alias("remotes"))


def quoted_paths(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "name_vocab").select("name_id", urls.quote_path(F.concat(F.lit("https://h.example/a/"), "display_name")).alias("quoted"))


def safe_names(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lives").select("live_id", names.safe_path(F.concat_ws("/", "group_name", "name")).alias("path"))


def content_kinds(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("text")
    return table(spark, d, "documents").groupBy(content.body_shape(t).alias("shape"), content.magic_kind(F.substring(t, 1, 64)).alias("kind")).agg(F.count(F.lit(1)).alias("n"))


def response_levels(spark: SparkSession, d: str) -> DataFrame:
    code = F.element_at(F.array(*[F.lit(x) for x in (200, 404, 503, 302, 206)]), (F.col("probe_id") % 5 + 1).cast("int"))
    return table(spark, d, "sites_probe").groupBy(content.response_class(code, F.col("api")).alias("level")).agg(F.count(F.lit(1)).alias("n"))


def health_of_levels(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "interfaces")
    return t.groupBy(grades.level_health(F.col("level")).alias("health_class"), grades.level_rank(F.col("level")).alias("rank")).agg(F.count(F.lit(1)).alias("n"))


def funnel_grade(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "sites_probe")
    g = grades.funnel_grade(F.col("key").isNotNull(), F.col("api").isNotNull(), F.col("l1_ok"), F.size("names") > 0, F.col("ms") < 500)
    return p.select("probe_id", g.alias("grade"))


def site_kinds(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "sites").groupBy(grades.site_kind(F.col("group_name")).alias("kind")).agg(F.count(F.lit(1)).alias("n"))


def idle_days(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "interfaces").select("snapshot_date", "key", grades.days_since(F.col("last_seen"), "2026-10-05").alias("idle")).distinct()


def record_hashes(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "interfaces")
    return t.groupBy(content.canonical_hash("health", "level").alias("hash")).agg(F.count(F.lit(1)).alias("n"))


def failure_fingerprints(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "interfaces").where("health = 'dead'")
    return t.groupBy(content.failure_fingerprint(F.col("source"), F.col("level")).alias("fingerprint")).agg(F.count(F.lit(1)).alias("n"))


def channel_classes(spark: SparkSession, d: str) -> DataFrame:
    marker = F.when(F.col("group_name") == "海外", "abroad").otherwise("")
    return table(spark, d, "lives").groupBy(names.channel_class(F.col("name"), marker).alias("class")).agg(F.count(F.lit(1)).alias("n"))


def link_harvest(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("source", F.explode(urls.harvest_links(F.col("text"))).alias("url"))
    return docs.where(~F.col("url").contains(".test/")).groupBy("url").agg(F.count_distinct("source").alias("sources"), F.min("source").alias("first_source"))


def hash_shard(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "sites_probe").groupBy(content.md5_mod(F.col("key"), 16).alias("shard")).agg(F.count(F.lit(1)).alias("n"))


def repo_references(spark: SparkSession, d: str) -> DataFrame:
    made = F.concat(F.lit("https://ghproxy.net/https://raw.githubusercontent.com/"), "src", F.lit("/r/main/"), urls.path_norm(F.col("jar")))
    return table(spark, d, "sites").where(F.col("jar") != "").select(urls.repo_ref(made).alias("r")).select("r.*").distinct()


def deep_verdicts(spark: SparkSession, d: str) -> DataFrame:
    code = F.replace(F.col("level"), F.lit("L"), F.lit("G"))
    return table(spark, d, "sites_probe").select(grades.deep_verdict(code).alias("v")).select("v.level", "v.reason").groupBy("level", "reason").agg(F.count(F.lit(1)).alias("n"))


QUERIES = {
    f.__name__: f
    for f in (
        canonical_url_key, endpoint_form, name_forms, tag_and_score, normalized_names, reference_paths, bare_references, url_classes, remote_counts, quoted_paths,
        safe_names, content_kinds, response_levels, health_of_levels, funnel_grade, site_kinds, idle_days, record_hashes, failure_fingerprints, channel_classes,
        link_harvest, hash_shard, repo_references, deep_verdicts,
    )
}

_NORMAL_FULL = "".join(chr(c) for c in range(0xFF01, 0xFF5F))
_NORMAL_HALF = "".join(chr(c) for c in range(0x21, 0x7F)).replace("'", "''")
NORMAL_NAME = f"""regexp_replace(lower(translate(translate(replace(regexp_replace({_U.format('name')}, '^(?:[【\\[][^】\\]]*[】\\]]\\s*)+', ''), '　', ' '), '{_NORMAL_FULL}', '{_NORMAL_HALF}'), '{names.TRAD[0]}', '{names.TRAD[1]}')), '[\\s_\\-·•|┃.]+', '', 'g')"""
_BAD = "[<>:\"|?*\\\\\\x00-\\x1f]"
_SAFE = f"""(CASE WHEN rtrim(regexp_replace(s, '{_BAD}', '_', 'g'), ' .') = '' THEN '_'
  WHEN upper(split_part(rtrim(regexp_replace(s, '{_BAD}', '_', 'g'), ' .'), '.', 1)) IN ({', '.join(repr(x) for x in names.RESERVED)}) THEN '_' || rtrim(regexp_replace(s, '{_BAD}', '_', 'g'), ' .')
  ELSE rtrim(regexp_replace(s, '{_BAD}', '_', 'g'), ' .') END)"""


def _cases(c: str, values: dict, default: object) -> str:
    lit = lambda v: f"'{v}'" if isinstance(v, str) else str(v)
    return f"CASE {c} " + " ".join(f"WHEN '{k}' THEN {lit(v)}" for k, v in values.items()) + f" ELSE {lit(default)} END"


SQL = {
    "canonical_url_key": f"SELECT row_id, {_canonical('api')} AS canonical, lower(CASE WHEN regexp_matches({_U.format('api')}, '^(?i)https?://') THEN {_canonical('api')} ELSE {_U.format('api')} END) AS api_ci FROM sites",
    "endpoint_form": f"""SELECT row_id, CASE WHEN regexp_matches(u, '^(?i)https?://') THEN 'https://' || lower(regexp_extract(t, '^([^/]*)', 1)) || regexp_replace(regexp_extract(t, '(?s)^[^/]*(.*)$', 1), '/+$', '') ELSE u END AS endpoint,
        lower(regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.\\-]*://(?:[^/?#@]*@)?([^/?#]*)', 1)) AS host
        FROM (SELECT row_id, {_U.format('api')} AS u, regexp_replace({_U.format('api')}, '^(?i)https?://', '') AS t FROM sites)""",
    "name_forms": f"""SELECT live_id, lower(regexp_replace(coalesce(name, ''), '[^\\p{{L}}\\p{{N}}]+', '', 'g')) AS title, TRY_CAST(nullif(regexp_extract(name, '\\[(\\d{{1,9}})ms', 1), '') AS INT) AS latency,
        regexp_replace(lower({_U.format('name')}), '[\\s_\\-·•]+', '', 'g') AS key_form, regexp_replace(coalesce(group_name, ''), '^(综合|4K)-', '') AS core FROM lives""",
    "tag_and_score": """SELECT row_id, CASE WHEN coalesce(origin, '') <> '' THEN substr(regexp_replace(split_part(origin, '/', -1), '^\\d+-', ''), 1, 12) WHEN coalesce(key, '') <> '' THEN substr(key, 1, 8) ELSE 'unk' END AS tag,
        (CASE WHEN regexp_matches(coalesce(name, ''), '\\[\\d+ms') THEN 10 ELSE 0 END + CASE WHEN searchable = 1 THEN 5 ELSE 0 END + CASE WHEN quick_search = 1 THEN 3 ELSE 0 END + CASE WHEN coalesce(api, '') <> '' THEN 2 ELSE 0 END) AS score FROM sites""",
    "normalized_names": f"SELECT live_id, {NORMAL_NAME} AS norm FROM lives",
    "reference_paths": f"""WITH p AS (SELECT row_id, list_filter(list_transform(string_split(coalesce(ext, ''), '$$$'), lambda x: regexp_replace(regexp_replace(x, '(?s);.*$', ''), '^\\s+|\\s+$', '', 'g')), lambda x: regexp_matches(x, '^\\.{{1,2}}/')) AS l FROM sites),
        r AS (SELECT row_id, unnest(range(len(l)))::INT AS pos, unnest(l) AS ref FROM p),
        f AS (SELECT *, list_filter(list_transform(string_split(replace(ref, '\\', '/'), '/'), lambda s: CASE WHEN s = '' THEN 'empty segment' WHEN regexp_matches(s, '{_BAD}') THEN 'illegal character' WHEN regexp_matches(s, '[ .]$') THEN 'ends with dot or space'
          WHEN upper(split_part(s, '.', 1)) IN ({', '.join(repr(x) for x in names.RESERVED)}) THEN 'reserved name' END), lambda x: x IS NOT NULL) AS why FROM r)
        SELECT row_id, pos, ref, array_to_string(list_filter(string_split(ltrim(replace(ref, '\\', '/'), './'), '/'), lambda s: s <> '' AND s <> '.'), '/') AS path, coalesce(why[1], CASE WHEN length(ref) > 240 THEN 'too long' ELSE '' END) AS reason FROM f""",
    "bare_references": f"""SELECT row_id, {_PROXY.format("regexp_replace(trim(jar), '(?is);md5;.*$', '')")} AS bare, substr(md5(trim(jar)), 1, 10) || '-' || regexp_extract(regexp_replace(trim(jar), '(?s)[?#;].*$', ''), '([^/]*)/*$', 1) AS file FROM sites WHERE jar IS NOT NULL""",
    "url_classes": f"""SELECT CASE WHEN u = '' THEN 'no_url' WHEN regexp_matches(u, '^(\\./|\\.\\./|/|file:)') THEN 'local' WHEN regexp_matches(u, '^(?i)https?://[^/]*(github|ghproxy)') THEN 'gh'
        WHEN regexp_matches(u, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN 'direct' ELSE 'no_url' END AS url_class, count(*) AS n FROM (SELECT {_U.format('url')} AS u FROM lives) GROUP BY 1""",
    "remote_counts": """SELECT row_id, len(list_filter(regexp_extract_all(coalesce(ext, ''), 'https?://[^\\s"'',;$|#\\\\\\[\\]]+'), lambda u: NOT regexp_matches(u, '^https?://(?:localhost|127\\.|10\\.|192\\.168\\.|172\\.(?:1[6-9]|2[0-9]|3[01])\\.|0\\.0\\.0\\.0)')))::INT AS remotes FROM sites""",
    "quoted_paths": """SELECT name_id, 'https://h.example' || array_to_string(list_transform(string_split('/a/' || display_name, '/'), lambda s: url_encode(s)), '/') AS quoted FROM name_vocab""",
    "safe_names": f"""WITH p AS (SELECT live_id, list_filter(string_split(replace(concat_ws('/', group_name, name), '\\', '/'), '/'), lambda s: s NOT IN ('', '.', '..')) AS l FROM lives),
        j AS (SELECT live_id, array_to_string(list_transform(l, lambda s: {_SAFE}), '/') AS q FROM p) SELECT live_id, CASE WHEN q = '' THEN '_' ELSE q END AS path FROM j""",
    "content_kinds": f"""WITH t AS (SELECT coalesce(text, '') AS x, text, regexp_replace(coalesce(text, ''), '^[\\s\ufeff]+', '') AS t, substr(text, 1, 64) AS h FROM documents), k AS (SELECT *, regexp_replace(h, '^[ \\t\\n\\r\\x0b\\x0c]+', '') AS l FROM t)
        SELECT CASE WHEN starts_with(x, '\ufeff') THEN 'bom' WHEN starts_with(t, '#EXTM3U') OR regexp_matches(t, '(^|\\n)[^\\n]*,#genre#') THEN 'live' WHEN regexp_matches(t, '^<(?i:!doctype|html)') THEN 'html' WHEN regexp_matches(t, '^[\\[{{]') THEN 'json' ELSE 'other' END AS shape,
        CASE WHEN text IS NULL THEN NULL WHEN starts_with(l, '<!DOCTYPE') OR starts_with(l, '<!doctype') OR starts_with(l, '<html') THEN 'html' WHEN starts_with(l, '{{') THEN 'json'
        WHEN regexp_matches(CASE WHEN strlen(h) <= 64 THEN l ELSE l END, '[^\\x00-\\x7f]') THEN 'binary' ELSE 'text' END AS kind, count(*) AS n FROM k GROUP BY 1, 2""",
    "response_levels": """SELECT CASE WHEN code BETWEEN 200 AND 299 AND regexp_matches(b, '^\\s*[\\[{]') THEN 'E2' WHEN code BETWEEN 200 AND 299 AND length(trim(b)) > 0 THEN 'E1' WHEN code IN (404, 410) OR code >= 500 THEN 'E0' ELSE 'E?' END AS level, count(*) AS n
        FROM (SELECT [200, 404, 503, 302, 206][probe_id % 5 + 1] AS code, api AS b FROM sites_probe) GROUP BY 1""",
    "health_of_levels": f"SELECT {_cases('level', grades.LEVEL_HEALTH, 'unknown')} AS health_class, {_cases('level', grades.LEVEL_RANK, 7)} AS rank, count(*) AS n FROM interfaces GROUP BY 1, 2",
    "funnel_grade": """WITH g AS (SELECT probe_id, key IS NOT NULL AS a, api IS NOT NULL AS b, coalesce(l1_ok, false) AS c, coalesce(len(names) > 0, false) AS d, coalesce(ms < 500, false) AS e FROM sites_probe)
        SELECT probe_id, CASE WHEN a AND b AND c AND d AND e THEN 'D5' WHEN d THEN 'D4' WHEN c THEN 'D3' WHEN b THEN 'D2' WHEN a THEN 'D1' ELSE 'D0' END AS grade FROM g""",
    "site_kinds": """SELECT CASE WHEN contains(g, '蜘蛛') THEN 'csp' WHEN contains(g, '本地JS') THEN 'js' WHEN contains(g, '网盘') THEN 'pan' WHEN g = '短剧' THEN 'short' WHEN contains(g, '采集站') OR contains(g, '直连') THEN 'std' ELSE 'other' END AS kind, count(*) AS n
        FROM (SELECT coalesce(group_name, '') AS g FROM sites) GROUP BY 1""",
    "idle_days": "SELECT DISTINCT snapshot_date, key, coalesce(date_diff('day', TRY_CAST(nullif(trim(last_seen), '') AS DATE), DATE '2026-10-05'), 9999) AS idle FROM interfaces",
    "record_hashes": """SELECT sha256('{"health":' || coalesce('"' || trim(health) || '"', 'null') || ',"level":' || coalesce('"' || trim(level) || '"', 'null') || '}') AS hash, count(*) AS n FROM interfaces GROUP BY 1""",
    "failure_fingerprints": "SELECT substr(sha1(concat_ws('|', source, level)), 1, 8) AS fingerprint, count(*) AS n FROM interfaces WHERE health = 'dead' GROUP BY 1",
    "channel_classes": """WITH n AS (SELECT coalesce(name, '') AS n, group_name AS g FROM lives), m AS (SELECT *, TRY_CAST(nullif(regexp_extract(upper(n), '(?:CCTV|[A-Z]{3})[-\\s]?(\\d{1,2})(?:\\D|$)', 1), '') AS INT) AS num FROM n)
        SELECT CASE WHEN g = '海外' THEN 'source:abroad' WHEN num BETWEEN 1 AND 17 THEN 'numbered' WHEN regexp_matches(n, '香港|澳门|台湾|港澳') THEN 'region' WHEN regexp_matches(n, '轮播|循环') AND NOT regexp_matches(n, '新闻') THEN 'loop'
        WHEN regexp_matches(n, '省|市|县|地方|少儿|卫视') THEN 'local' ELSE 'other' END AS class, count(*) AS n FROM m GROUP BY 1""",
    "link_harvest": """WITH u AS (SELECT source, regexp_replace(unnest(regexp_extract_all(coalesce(text, ''), 'https?://[^\\s<>"''()\\[\\]，。、；]+')), '[.,;:!?]+$', '') AS url FROM documents)
        SELECT url, count(DISTINCT source) AS sources, min(source) AS first_source FROM u WHERE NOT contains(url, '.test/') GROUP BY url""",
    "hash_shard": "SELECT (('0x' || substr(md5(key), 32, 1))::INT)::BIGINT AS shard, count(*) AS n FROM sites_probe GROUP BY 1",
    "repo_references": """WITH j AS (SELECT src, array_to_string(list_filter(string_split(ltrim(replace(jar, '\\', '/'), './'), '/'), lambda s: s <> '' AND s <> '.'), '/') AS p FROM sites WHERE jar <> '')
        SELECT DISTINCT src AS owner, 'r' AS repo, 'main' AS ref, regexp_extract(p, '^([^?#]+)', 1) AS path FROM j""",
    "deep_verdicts": """WITH c AS (SELECT coalesce(replace(level, 'L', 'G'), '') AS c FROM sites_probe) SELECT CASE WHEN regexp_matches(c, '^G[1-9]$') THEN 'C' || substr(c, 2) WHEN c IN ('G0', 'C0') THEN NULL WHEN c = '' THEN 'C?' ELSE c END AS level,
        CASE WHEN c = 'G0' THEN 'g0' WHEN c = 'C0' THEN 'load' ELSE '' END AS reason, count(*) AS n FROM c GROUP BY 1, 2""",
}
