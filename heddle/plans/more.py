"""Queries for links, rounds, gates, merges, indexes, rules and for sources and sinks, which write, read back and are compared."""

from __future__ import annotations

import io
import uuid
import zipfile

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heddle.functions import content, names, urls
from heddle.operators import catalog, history, joins, labels, state
from heddle.plans.tables import AFTER, AS_OF, BEFORE, _A, _B, _snapshot
from heddle.plans.tables_sql import _RANK
from heddle.plans.texts import _LINES, _lines
from heddle.runtime import durable, shared_dir, table
from heddle.sources import documents, playlist
from heddle.streaming import ingest

_KEEP, _DROP = r"\.(?:m3u8?|json|txt|flv)(?:\?|$)|/(?:vod|play|live)/", r"\.invalid/|/play/[0-9]"


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/heddle-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


# Links, rounds and gates


def link_categories(spark: SparkSession, d: str) -> DataFrame:
    """Links of three tables with the set of what they were found as."""
    lives = table(spark, d, "lives").where("url like 'http%'").select("url", "name", "group_name", "live_id")
    sites = table(spark, d, "sites").where("api like 'http%'").select(F.col("api").alias("url"), "name", F.col("type").cast("string").alias("type"), "row_id")
    docs = table(spark, d, "documents").select(F.explode(urls.harvest_links(F.col("text"))).alias("url"), F.col("title").alias("name"), "lang", "doc_id")
    parts = [(lives.withColumnRenamed("live_id", "at"), "live", F.col("group_name")), (sites.withColumnRenamed("row_id", "at"), "site", F.col("type")), (docs.withColumnRenamed("doc_id", "at"), "text", F.col("lang"))]
    return catalog.collect_links(parts, order="at")


def kept_links(spark: SparkSession, d: str) -> DataFrame:
    """Links of playlists and players in documents, without hosts and paths to drop."""
    docs = table(spark, d, "documents").select("source", F.explode(urls.harvest_links(F.col("text"), keep=_KEEP, drop=_DROP)).alias("url"))
    return docs.groupBy("url").agg(F.count(F.lit(1)).alias("texts"), F.min("source").alias("first_source"))


def fresh_round_winners(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "interfaces").where("latency_ms is not null").groupBy("source", "snapshot_date").agg(F.min("latency_ms").alias("ms"))
    t = catalog.fresh_rounds(t, at="snapshot_date", as_of=f"{AFTER} 12:00:00", days=4)
    return catalog.round_winner(t, item="source", round="snapshot_date", value="ms", least=2)


def promotion_gates(spark: SparkSession, d: str) -> DataFrame:
    entries = _snapshot(spark, d, AFTER).select("key", "name", F.when(F.col("level") == "S0", "stub").alias("label"))
    seen = F.col("health").isin("healthy", "degraded")
    probes = table(spark, d, "interfaces").where("key is not null").groupBy("key", "snapshot_date").agg(F.bool_or(seen).alias("ok"))
    out = table(spark, d, "name_vocab").where("name_id % 7 = 0").select(F.col("display_name").alias("name"))
    return history.promotion(entries, probes, id="key", channel="name", label="label", quarantined=out, success="ok", at="snapshot_date", as_of=AS_OF, days=4, max_failures=2, rate=(6, 10))


# Merges and indexes


def upserted_levels(spark: SparkSession, d: str) -> DataFrame:
    address = lambda c: F.nullif(urls.canonical_url(c), F.lit(""))
    entries = _snapshot(spark, d, BEFORE).select("key", F.when(F.length("key") % 2 == 0, address(F.col("api"))).alias("address"), F.lit(BEFORE).alias("day"), "level")
    rows = table(spark, d, "sites_probe").where("level is not null").select("key", address(F.col("api")).alias("address"), F.date_format("generated_at", "yyyy-MM-dd").alias("day"), "level")
    return joins.upsert_levels(entries, rows, name="key", address="address", day="day", level="level", best=["L3", "L2"])


def ledger_files(spark: SparkSession, d: str) -> DataFrame:
    """The local files of references that are written in full, behind a mirror, or as a relative path."""
    jars = table(spark, d, "sites").where("jar <> ''")
    path = urls.path_norm(urls.bare_ref(F.col("jar")))
    address = F.concat(F.lit("https://files.example/"), path)
    ledger = jars.select(address.alias("url"), path.alias("file")).distinct()
    k = F.col("row_id") % 4
    ref = F.when(k == 0, address).when(k == 1, F.concat(F.lit("https://ghproxy.net/"), address, F.lit(";md5;00"))).when(k == 2, F.col("jar")).otherwise(F.col("api"))
    return joins.ledger_resolve(jars.select("row_id", ref.alias("ref")), ledger, ref="ref", url="url", local="file", name="file").select("row_id", "file")


def index_actions(spark: SparkSession, d: str) -> DataFrame:
    """What an incremental index of the sources' keys does with each of them."""
    ok = F.coalesce(F.col("health").isin("healthy", "degraded"), F.lit(False))
    prev = _snapshot(spark, d, BEFORE).where("source is not null").select(F.col("source").alias("repo"), F.lit("P").alias("pushed_at"), F.col("key").alias("path"), F.md5("api").alias("sha"), ok.alias("ok"), F.date_sub(F.lit(BEFORE).cast("date"), F.length("key") % 12).alias("at"))
    now = _snapshot(spark, d, AFTER).where("source is not null")
    k = F.length("source") % 3
    repos = now.select(F.col("source").alias("repo"), F.when(k == 1, "P").when(k == 2, "Q").alias("pushed_at")).where(~F.col("repo").endswith("1")).distinct()
    files = now.select(F.col("source").alias("repo"), F.col("key").alias("path"), F.md5("api").alias("sha"))
    return state.index_plan(prev, repos, files, as_of=AS_OF, wait=10, ttl=15)


def cascaded_prune(spark: SparkSession, d: str) -> DataFrame:
    """How many interfaces and how many of their checks stay."""
    kept, checks = state.stale_cascade(_snapshot(spark, d, AFTER), table(spark, d, "sites_probe"), key="key", seen="last_seen", as_of=AS_OF, grace=4)
    one = lambda df, name: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("part"), "n")
    return one(kept, "interfaces").unionByName(one(checks, "checks"))


# Rules, documents and lines


def scrubbed_lines(spark: SparkSession, d: str) -> DataFrame:
    return labels.scrub_lines(_lines(spark, d), by="src", order="live_id", line="line", labelled=F.col("name").rlike("体育|TV")).select("live_id")


def rewritten_documents(spark: SparkSession, d: str) -> DataFrame:
    """Documents of one site each, with jars brought home and sites with failed ones removed."""
    jars = table(spark, d, "sites").where("jar <> ''").select(F.trim(F.substring_index("jar", ";", 1)).alias("j")).distinct().limit(10_001).collect()
    if len(jars) > 10_000:
        raise ValueError("more than 10000 jars: join them instead")
    failed = {r.j for r in jars if len(r.j) % 5 == 0}
    local = {r.j: "home/" + r.j.rsplit("/", 1)[-1] for r in jars if r.j not in failed}
    site = F.struct("key", F.concat("jar", F.lit("$$$./own.jar")).alias("jar"))
    docs = table(spark, d, "sites").where("jar <> ''").select("row_id", F.to_json(F.struct(F.array(site).alias("sites"), F.substring_index("jar", ";", 1).alias("home"))).alias("doc"))
    made = catalog.rewrite_documents(docs, id="row_id", column="doc", local=local, failed=failed)
    part = lambda p: F.get_json_object("text", p)
    return made.select(F.col("id").alias("row_id"), "removed", part("$.sites[0].jar").alias("jar"), part("$.home").alias("home"))


def rule_texts(spark: SparkSession, d: str) -> DataFrame:
    v = table(spark, d, "name_vocab").select(F.concat(F.lit("rules-"), F.col("name_id") % 3).alias("document"), F.substring("display_name", 1, 1).alias("key"), F.col("display_name").alias("value"))
    folder = _folder(spark, "rules")
    for _ in range(2):  # writing the same rules again changes nothing
        documents.write_rules(documents.rule_documents(v, document="document", key="key", value="value"), folder)
    return spark.read.text(folder).select("document", F.col("value").alias("json"))


def canonical_documents(spark: SparkSession, d: str) -> DataFrame:
    """Different JSON texts by the hash of their one form."""
    t = table(spark, d, "sites").where("ext like '{%'").select("ext", content.canonical_json_hash(F.col("ext")).alias("hash"))
    return t.where("hash is not null").groupBy("hash").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("ext").alias("spellings"))


def stream_bodies(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("live_id") % 5
    name = F.coalesce("name", F.lit(""))
    body = F.when(k == 0, F.concat(F.lit("#EXTM3U\n"), name)).when(k == 1, F.concat(F.lit("FLV"), name)).when(k == 2, F.rpad(F.lit("G"), 189, "G")).when(k == 3, F.concat(F.lit("G"), name)).otherwise(name)
    return table(spark, d, "lives").select("live_id", content.looks_like_stream(body).alias("stream"))


def public_fields(spark: SparkSession, d: str) -> DataFrame:
    """Records without their private fields at any depth."""
    t = table(spark, d, "sites").select("row_id", F.col("src").alias("_src"), F.struct(F.coalesce("key", F.lit("")).alias("key"), F.col("api").alias("_api"), F.array(F.struct(F.coalesce("name", F.lit("")).alias("name"), F.col("ord").alias("_ord"))).alias("items")).alias("rec"))
    out = documents.strip_private(t)
    return out.select(F.col(out.columns[0]), F.concat_ws("|", *[f"rec.{f.name}" for f in out.schema["rec"].dataType.fields if f.name != "items"], *[F.col(f"rec.items.{f.name}")[0] for f in out.schema["rec"].dataType["items"].dataType.elementType.fields]).alias("text"), F.lit(len(out.columns)).alias("columns"))


def miss_reasons(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "lives").select("live_id", F.coalesce("url", F.lit("")).alias("u"), F.element_at(F.array(*[F.lit(x) for x in (200, 404, 410, 503)]), (F.col("live_id") % 4 + 1).cast("int")).alias("code"), F.coalesce(F.col("health") == "dead", F.lit(False)).alias("html"))
    return t.groupBy(urls.miss_reason(F.col("code"), F.col("u"), F.col("html")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def rule_shapes(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "sites").select("row_id", content.is_rule(F.col("ext")).alias("rule"))


# Sources and sinks


def json_document(spark: SparkSession, d: str) -> DataFrame:
    """A JSON document of all nations, read tolerantly; a missing one has no rows."""
    folder = _folder(spark, "doc")
    table(spark, d, "nation").agg(F.to_json(F.sort_array(F.collect_list(F.struct("n_nationkey", "n_name")))).alias("value")).coalesce(1).write.text(folder)
    schema = "n_nationkey int, n_name string"
    return documents.load_json(spark, f"{folder}/part-*", schema).unionByName(documents.load_json(spark, f"{folder}/none.json", schema))


def jsonl_history(spark: SparkSession, d: str) -> DataFrame:
    """JSON lines, replaced once, appended to, with bad lines between; the good ones by source."""
    folder = _folder(spark, "lines")
    rows = table(spark, d, "sites").select("row_id", "src", "key")
    documents.replace_json(rows.where("row_id % 2 = 1"), folder)
    documents.replace_json(rows.where("row_id % 2 = 0"), folder)
    documents.append_jsonl(rows.where("row_id % 2 = 1"), folder)
    rows.where("row_id % 10 = 0").select(F.concat(F.lit('{"row_id": '), "row_id", F.lit(', "src": broken')).alias("value")).write.mode("append").text(folder)
    return documents.load_jsonl(spark, folder, "row_id long, src string, key string").groupBy("src").agg(F.count(F.lit(1)).alias("n"), F.sum("row_id").alias("ids"), F.count("key").alias("n_keys"))


def file_hashes(spark: SparkSession, d: str) -> DataFrame:
    folder = _folder(spark, "files")
    table(spark, d, "nation").select("n_nationkey", "n_name").repartition("n_nationkey").write.partitionBy("n_nationkey").text(folder)
    return documents.inventory(spark, folder, content=True).select("length", "kind", "md5", "sha1", "sha256")


def decoded_texts(spark: SparkSession, d: str) -> DataFrame:
    """Texts in one or two layers of encoding, opened again."""
    t = table(spark, d, "documents").where(F.col("text").rlike("[.。]")).select("doc_id", "text")
    one = F.base64(F.encode("text", "utf-8"))
    k = F.col("doc_id") % 4
    body = F.when(k == 0, one).when(k == 1, F.concat(F.lit("cfg**"), one)).when(k == 2, F.concat(F.lit("x**"), F.base64(F.encode(one, "utf-8")))).otherwise(F.col("text"))
    return documents.decoded(t.select("doc_id", F.encode(body, "utf-8").alias("b")), "b", "plain").select("doc_id", F.md5("plain").alias("md5"), F.col("plain_error").isNotNull().alias("failed"))


def written_playlist(spark: SparkSession, d: str) -> DataFrame:
    """A playlist written as text and parsed again: each address once."""
    folder = _folder(spark, "m3u")
    t = table(spark, d, "lives").where("url like 'http%' and not contains(url, '\n')").select(F.concat(F.lit("n"), F.regexp_replace(F.coalesce("name", F.lit("")), r"[,\s]", "")).alias("name"), F.coalesce("group_name", F.lit("")).alias("grp"), F.trim("url").alias("url"), "channels")
    playlist.m3u_lines(t, name="name", group="grp", url="url", speed="channels").write.text(folder)
    return playlist.parse_playlists(playlist.read_texts(spark, folder)).select("url")


def exported_subsets(spark: SparkSession, d: str) -> DataFrame:
    folder = _folder(spark, "subsets")
    documents.export_subsets(table(spark, d, "lives").select("live_id", F.coalesce("health", F.lit("none")).alias("health"), F.coalesce("group_name", F.lit("none")).alias("grp")), folder, ["health", "grp"])
    return spark.read.parquet(folder).groupBy("health", "grp").agg(F.count(F.lit(1)).alias("n"), F.max("live_id").alias("last"))


def nul_list(spark: SparkSession, d: str) -> DataFrame:
    folder = _folder(spark, "nul")
    table(spark, d, "sites").where("jar <> ''").select("jar").distinct().write.option("lineSep", "\0").text(folder)
    return documents.read_nul_list(spark, folder)


def registry(spark: SparkSession, d: str) -> DataFrame:
    old = table(spark, d, "supplier").select("s_suppkey", F.lit("old").alias("state"))
    return documents.upsert_registry(old, old.where("s_suppkey % 3 = 0").select((F.col("s_suppkey") * 2).alias("s_suppkey"), F.lit("new").alias("state")), "s_suppkey")


def write_guards(spark: SparkSession, d: str) -> DataFrame:
    """Which guards let results through: share of verdicts, size, required column, age."""

    def passes(check) -> bool:
        try:
            return check() is not False
        except ValueError:
            return False

    t = table(spark, d, "interfaces").select("key", "updated_at", (F.col("type") == 3).alias("local"), F.col("level").isNotNull().alias("verdict"))
    local, verdict = F.coalesce("local", F.lit(False)), F.col("verdict")
    rows = [
        ("verdicts", passes(lambda: labels.may_overwrite(t, local=local, verdict=verdict, floor=(1, 2), old_exists=True))),
        ("verdicts strict", passes(lambda: labels.may_overwrite(t, local=local, verdict=verdict, floor=(1, 1), old_exists=True))),
        ("size", passes(lambda: labels.require(t, 100, ["key"]))),
        ("column", passes(lambda: labels.require(t, 1, ["missing"]))),
        ("age", passes(lambda: labels.require(t, 1, ["key"], at="updated_at", as_of="2026-10-01 00:00:00", hours=48))),
        ("age strict", passes(lambda: labels.require(t, 1, ["key"], at="updated_at", as_of="2027-10-01 00:00:00", hours=48))),
    ]
    return spark.createDataFrame(rows, "guard string, passed boolean")


def rewritten_products(spark: SparkSession, d: str) -> DataFrame:
    """Paths in a text replaced, the longest first."""
    pairs = [("/api", "/A"), ("/api.php", "/B"), ("/api.php/provide", "/C"), ("vod", "v")]
    return table(spark, d, "sites").select("row_id", documents.rewrite_references(F.col("api"), pairs).alias("api"))


def reports(spark: SparkSession, d: str) -> DataFrame:
    """The regions as Markdown and as a page."""
    t = table(spark, d, "region").select("r_regionkey", "r_name").orderBy("r_regionkey")
    return spark.createDataFrame([("markdown", documents.markdown_table(t)), ("html", documents.html_table(t, "Regions")), ("short", documents.markdown_table(t, most=1))], "kind string, text string")


def ascii_hosts(spark: SparkSession, d: str) -> DataFrame:
    """Addresses with a host that isn't ASCII, made requestable; path and query stay as they are."""
    tail = F.regexp_replace(F.coalesce("url", F.lit("")), "(?s)^[A-Za-z]+://[^/?#]*", "")
    t = table(spark, d, "lives").select("live_id", F.concat(F.lit("http://"), F.element_at(F.array(*[F.lit(h) for h in ("bücher.example", "例子.test", "plain.test")]), (F.col("live_id") % 3 + 1).cast("int")), F.lit(":8080/"), tail).alias("url"))
    return documents.requestable_hosts(t, "url", "sent").select("live_id", "sent")


def archives(spark: SparkSession, d: str) -> DataFrame:
    """Names in zip archives, some of them broken, and the reason why they have no classes."""

    @F.pandas_udf("binary")
    def packed(names_: pd.Series) -> pd.Series:
        def one(name: str) -> bytes:
            with zipfile.ZipFile(out := io.BytesIO(), "w") as z:
                for x in (f"z/{name}.txt", "a.json"):
                    z.writestr(x, name)
            return out.getvalue() if len(name) % 2 else b"broken"

        return names_.map(one)

    t = durable(table(spark, d, "nation").select("n_name", packed("n_name").alias("content")))
    entries = documents.archive_entries(t, path="n_name", content="content")
    classes = documents.dex_classes(t, path="n_name", content="content")
    return entries.join(classes, "path").select("path", F.col("error").isNotNull().alias("broken"), F.coalesce(F.array_join("entries", ","), F.lit("")).alias("entries"), F.substring_index("err", ":", 1).alias("err"), F.col("classes").isNull().alias("no_classes"))


def ratio_sample(spark: SparkSession, d: str) -> DataFrame:
    return history.hash_sample(table(spark, d, "customer").select("c_custkey"), "c_custkey", "seed2", ratio=(1, 20))


def streamed_verdicts(spark: SparkSession, d: str) -> DataFrame:
    """The verdicts of all probes as a stream leaves them when it has caught up."""
    name = "sites_probe.parquet"
    probes = spark.readStream.schema(table(spark, d, "sites_probe").schema).option("pathGlobFilter", "*.parquet").parquet(f"{d}/{name}*")
    p = probes.where("key is not null and level is not null")
    from heddle.functions import grades

    rows = p.select("key", F.col("type").alias("priority"), grades.level_rank(F.col("level")).alias("rank"), F.coalesce(F.col("total") > 0, F.lit(False)).alias("evidence"), "level", F.struct("generated_at", "probe_id").alias("at"))
    out, at = _folder(spark, "verdicts"), _folder(spark, "progress")
    keep = lambda df, _: df.write.mode("overwrite").parquet(out)
    q = ingest.stream_verdicts(rows, key="key").writeStream.outputMode("complete").foreachBatch(keep).option("checkpointLocation", at).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema("key string, level string").parquet(out)


def simplified_names(spark: SparkSession, d: str) -> DataFrame:
    """Names in their normal form, with the whole table of traditional characters."""
    n = names.normalize_name(F.col("name"), names.traditional_table(spark))
    return table(spark, d, "lives").where("name is not null").groupBy(n.alias("form")).agg(F.count(F.lit(1)).alias("n"))


_FUNCTIONS = [v for k, v in list(globals().items()) if callable(v) and getattr(v, "__module__", "") == __name__ and not k.startswith("_")]
QUERIES = {f.__name__: f for f in _FUNCTIONS}


def _sql() -> dict[str, str]:
    from heddle.plans.scalars import NORMAL_NAME, _canonical

    found = "list_distinct(list_transform(regexp_extract_all(coalesce(text, ''), 'https?://[^\\s<>\"''()\\[\\]，。、；]+'), lambda u: regexp_replace(u, '[.,;:!?]+$', '')))"
    addr = f"nullif({_canonical('api')}, '')"
    path = "array_to_string(list_filter(string_split(ltrim(replace(regexp_replace(jar, '(?is);md5;.*$', ''), '\\', '/'), './'), '/'), lambda s: s <> '' AND s <> '.'), '/')"
    place = lambda c: f"CASE {c} WHEN 'L3' THEN 1 WHEN 'L2' THEN 2 ELSE 3 END"
    line_name = "CASE WHEN starts_with(t, '#EXTINF') THEN trim(regexp_extract(t, ',([^,]*)$', 1)) WHEN NOT starts_with(t, '#') AND contains(t, ',') AND NOT regexp_matches(t, ',\\s*#genre#$') THEN trim(split_part(t, ',', 1)) ELSE '' END"
    return {
        "link_categories": f"""WITH p AS (SELECT 0 AS part, live_id AS at_, url, concat_ws(':', 'live', group_name) AS c, name FROM lives WHERE url LIKE 'http%' UNION ALL SELECT 1, row_id, api, concat_ws(':', 'site', type::VARCHAR), name FROM sites WHERE api LIKE 'http%'
          UNION ALL SELECT 2, doc_id, unnest({found}), concat_ws(':', 'text', lang), title FROM documents)
          SELECT url, array_to_string(list_sort(list(DISTINCT c)), ',') AS categories, (list(name ORDER BY part, at_))[1] AS name FROM p WHERE url <> '' GROUP BY 1""",
        "kept_links": f"SELECT url, count(*) AS texts, min(source) AS first_source FROM (SELECT source, unnest({found}) AS url FROM documents) WHERE regexp_matches(url, '{_KEEP}') AND NOT regexp_matches(url, '{_DROP}') GROUP BY 1",
        "fresh_round_winners": f"WITH m AS (SELECT source, snapshot_date, min(latency_ms) AS ms FROM interfaces WHERE latency_ms IS NOT NULL AND snapshot_date::TIMESTAMP >= TIMESTAMP '{AFTER} 12:00:00' - INTERVAL 4 DAY GROUP BY 1, 2) SELECT source, count(*) AS rounds, list_sort(list(ms))[(count(*) // 2 + 1)::INT] AS median FROM m GROUP BY 1 HAVING count(*) >= 2",
        "promotion_gates": f"""WITH e AS (SELECT key, name, level FROM {_A}), p AS (SELECT key, snapshot_date, bool_or(health IN ('healthy', 'degraded')) AS ok FROM interfaces WHERE key IS NOT NULL GROUP BY 1, 2),
          r AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY snapshot_date DESC) AS n FROM p WHERE ok IS NOT NULL), s AS (SELECT key, count(*) AS n, count(*) FILTER (ok) AS ok FROM r WHERE n <= 4 GROUP BY 1), f AS (SELECT key, min(snapshot_date) AS d FROM p GROUP BY 1),
          g AS (SELECT e.key, d, CASE WHEN e.name IN (SELECT display_name FROM name_vocab WHERE name_id % 7 = 0 AND display_name <> '') THEN 'quarantine' WHEN level = 'S0' THEN 'label' WHEN coalesce(s.n, 0) < 4 THEN 'days' WHEN s.n - s.ok > 2 THEN 'failures' WHEN s.ok * 10 < s.n * 6 THEN 'rate' ELSE '' END AS reason FROM e LEFT JOIN s USING (key) LEFT JOIN f USING (key))
          SELECT key, CASE WHEN reason = '' THEN 'promote' WHEN coalesce(date_diff('day', d::DATE, DATE '{AS_OF}') >= 21, false) THEN 'reject' ELSE 'keep' END AS action, reason FROM g""",
        "upserted_levels": f"""WITH e AS (SELECT key, CASE WHEN length(key) % 2 = 0 THEN {addr} END AS address, '{BEFORE}' AS day, level FROM {_B}), k AS (SELECT address, min(key) AS nm FROM e WHERE address IS NOT NULL GROUP BY 1),
          r AS (SELECT key, {addr} AS address, strftime(generated_at, '%Y-%m-%d') AS day, level FROM sites_probe WHERE level IS NOT NULL),
          t AS (SELECT coalesce(k.nm, CASE WHEN e.key IS NOT NULL AND e.address IS NOT NULL THEN r.address END, nullif(r.key, ''), r.address) AS key, r.address, r.day, r.level FROM r LEFT JOIN k ON k.address = r.address LEFT JOIN e ON e.key = r.key),
          n AS (SELECT key, day, min(({place('level')}, level)) AS b, min(address) AS address FROM t WHERE key IS NOT NULL GROUP BY 1, 2)
          SELECT coalesce(e.key, n.key) AS key, coalesce(e.address, n.address) AS address, coalesce(e.day, n.day) AS day,
            CASE WHEN n.key IS NOT NULL AND (e.level IS NULL OR b[1] < {place('e.level')} OR (b[1] = 3 AND {place('e.level')} = 3)) THEN b[2] ELSE e.level END AS level FROM e FULL JOIN n ON e.key = n.key AND e.day = n.day""",
        "ledger_files": f"SELECT row_id, CASE WHEN row_id % 4 < 3 THEN {path} END AS file FROM sites WHERE jar <> ''",
        "index_actions": f"""WITH p AS (SELECT source AS repo, key AS path, md5(api) AS sha, coalesce(health IN ('healthy', 'degraded'), false) AS ok, date_diff('day', DATE '{BEFORE}' - (length(key) % 12)::INT, DATE '{AS_OF}') AS age FROM {_B} WHERE source IS NOT NULL),
          n AS (SELECT source AS repo, key AS path, md5(api) AS sha FROM {_A} WHERE source IS NOT NULL), q AS (SELECT DISTINCT repo, CASE length(repo) % 3 WHEN 1 THEN 'P' WHEN 2 THEN 'Q' END AS pushed FROM n WHERE NOT ends_with(repo, '1')), h AS (SELECT DISTINCT repo FROM p),
          j AS (SELECT coalesce(p.repo, n.repo) AS repo, coalesce(p.path, n.path) AS path, p.sha AS old, n.sha AS new, ok, age, n.path IS NOT NULL AS there, p.path IS NOT NULL AS known FROM p FULL JOIN n ON p.repo = n.repo AND p.path = n.path),
          c AS (SELECT j.*, q.repo IS NOT NULL AND q.pushed IS NOT NULL AND (h.repo IS NULL OR q.pushed <> 'P') AS changed, q.repo IS NOT NULL AND q.pushed IS NULL AS lost FROM j LEFT JOIN q ON q.repo = j.repo LEFT JOIN h ON h.repo = j.repo),
          a AS (SELECT repo, path, CASE WHEN changed AND new IS NULL THEN 'gone' WHEN changed AND old IS DISTINCT FROM new THEN 'probe' WHEN old IS NULL THEN CASE WHEN changed THEN 'probe' END WHEN age > 15 THEN 'prune' WHEN ok THEN 'reuse' WHEN lost OR age < 10 THEN 'skip' ELSE 'probe' END AS action FROM c)
          SELECT * FROM a WHERE action IS NOT NULL""",
        "cascaded_prune": f"""WITH a AS (SELECT * FROM {_A}), g AS (SELECT key FROM a WHERE date_diff('day', TRY_CAST(nullif(trim(last_seen), '') AS DATE), DATE '{AS_OF}') > 4) SELECT 'interfaces' AS part, count(*) AS n FROM a WHERE key NOT IN (SELECT key FROM g) UNION ALL SELECT 'checks', count(*) FROM sites_probe WHERE key IS NULL OR key NOT IN (SELECT key FROM g)""",
        "scrubbed_lines": f"""WITH {_LINES}, t AS (SELECT *, regexp_replace(line, '^ +| +$', '', 'g') AS t FROM l), n AS (SELECT *, {line_name} AS name FROM t), h AS (SELECT *, name <> '' AND regexp_matches(name, '体育|TV') AS hit, starts_with(t, '#') AS mark FROM n),
          s AS (SELECT *, last_value(CASE WHEN mark THEN starts_with(t, '#EXTINF') AND hit END IGNORE NULLS) OVER (PARTITION BY src ORDER BY live_id ROWS UNBOUNDED PRECEDING) AS gone FROM h) SELECT live_id FROM s WHERE NOT coalesce(gone, false) AND NOT (NOT mark AND hit)""",
        "rewritten_documents": """WITH j AS (SELECT row_id, jar, trim(split_part(jar, ';', 1)) AS b FROM sites WHERE jar <> '') SELECT row_id, (length(b) % 5 = 0)::INT AS removed, CASE WHEN length(b) % 5 <> 0 THEN 'home/' || split_part(b, '/', -1) || substr(jar, length(b) + 1) || '$$$./own.jar' END AS jar,
          CASE WHEN length(b) % 5 <> 0 THEN 'home/' || split_part(b, '/', -1) ELSE split_part(jar, ';', 1) END AS home FROM j""",
        "rule_texts": "WITH l AS (SELECT 'rules-' || (name_id % 3) AS document, substr(display_name, 1, 1) AS k, list_sort(list(DISTINCT display_name)) AS v FROM name_vocab WHERE display_name IS NOT NULL GROUP BY 1, 2) SELECT document, '{' || string_agg(to_json(k) || ':' || to_json(v), ',' ORDER BY k) || '}' AS json FROM l GROUP BY 1",
        "canonical_documents": """WITH k AS (SELECT row_id, ext, unnest(list_sort(json_keys(ext))) AS k FROM sites WHERE ext LIKE '{%' AND json_valid(ext)), c AS (SELECT row_id, ext, '{' || string_agg(to_json(k) || ':' || CASE WHEN json_type(ext, '$."' || k || '"') = 'VARCHAR' THEN to_json(trim(json_extract_string(ext, '$."' || k || '"'))) ELSE json_extract(ext, '$."' || k || '"')::VARCHAR END, ',' ORDER BY k) || '}' AS t FROM k GROUP BY 1, 2)
          SELECT sha256(t) AS hash, count(*) AS n, count(DISTINCT ext) AS spellings FROM c GROUP BY 1""",
        "stream_bodies": "SELECT live_id, live_id % 5 IN (0, 1, 2) OR (live_id % 5 = 3 AND ascii(substr(coalesce(name, ''), 188, 1)) = 71) OR (live_id % 5 = 4 AND (starts_with(coalesce(name, ''), '#EXTM3U') OR starts_with(coalesce(name, ''), 'FLV'))) AS stream FROM lives",
        "public_fields": "SELECT row_id, coalesce(key, '') || '|' || coalesce(name, '') AS text, 2 AS columns FROM sites",
        "miss_reasons": """WITH t AS (SELECT [200, 404, 410, 503][live_id % 4 + 1] AS code, regexp_matches(coalesce(url, ''), '/[^/?#]+\\.[A-Za-z0-9]{1,5}([?#].*)?$') AS file, coalesce(health = 'dead', false) AS html FROM lives)
          SELECT CASE WHEN file AND code IN (404, 410) THEN 'gone-' || code WHEN file AND html THEN 'lander-html' ELSE '' END AS reason, count(*) AS n FROM t GROUP BY 1""",
        "rule_shapes": "SELECT row_id, regexp_matches(trim(coalesce(ext, '')), '^(?:[\\[{]|<\\?xml|<rss)') AND NOT regexp_matches(trim(coalesce(ext, '')), '^<(?i:!doctype|html)') AS rule FROM sites",
        "json_document": "SELECT n_nationkey::INT AS n_nationkey, n_name FROM nation",
        "jsonl_history": "SELECT src, count(*) AS n, sum(row_id)::BIGINT AS ids, count(key) AS n_keys FROM sites GROUP BY 1",
        "file_hashes": "SELECT (length(n_name) + 1)::BIGINT AS length, 'text' AS kind, md5(n_name || chr(10)) AS md5, sha1(n_name || chr(10)) AS sha1, sha256(n_name || chr(10)) AS sha256 FROM nation",
        "decoded_texts": "SELECT doc_id, md5(text) AS md5, false AS failed FROM documents WHERE regexp_matches(text, '[.。]')",
        "written_playlist": "SELECT DISTINCT trim(url) AS url FROM lives WHERE url LIKE 'http%' AND NOT contains(url, chr(10))",
        "exported_subsets": "SELECT coalesce(health, 'none') AS health, coalesce(group_name, 'none') AS grp, count(*) AS n, max(live_id) AS last FROM lives GROUP BY 1, 2",
        "nul_list": "SELECT DISTINCT jar AS path FROM sites WHERE jar <> ''",
        "registry": "SELECT s_suppkey * 2 AS s_suppkey, 'new' AS state FROM supplier WHERE s_suppkey % 3 = 0 UNION ALL SELECT s_suppkey, 'old' FROM supplier WHERE s_suppkey NOT IN (SELECT s_suppkey * 2 FROM supplier WHERE s_suppkey % 3 = 0)",
        "write_guards": """WITH t AS (SELECT count(*) FILTER (NOT coalesce(type = 3, false)) AS n, count(*) FILTER (NOT coalesce(type = 3, false) AND level IS NOT NULL) AS good, count(*) AS all_, max(updated_at) AS last FROM interfaces)
          SELECT 'verdicts' AS guard, good * 2 >= n AS passed FROM t UNION ALL SELECT 'verdicts strict', good >= n FROM t UNION ALL SELECT 'size', all_ >= 100 FROM t UNION ALL SELECT 'column', false UNION ALL SELECT 'age', last >= TIMESTAMP '2026-09-29 00:00:00' FROM t UNION ALL SELECT 'age strict', last >= TIMESTAMP '2027-09-29 00:00:00' FROM t""",
        "rewritten_products": "SELECT row_id, replace(replace(replace(replace(api, '/api.php/provide', '/C'), '/api.php', '/B'), '/api', '/A'), 'vod', 'v') AS api FROM sites",
        "reports": """WITH r AS (SELECT string_agg('| ' || r_regionkey || ' | ' || r_name || ' |', chr(10) ORDER BY r_regionkey) AS m, string_agg('<tr><td>' || r_regionkey || '</td><td>' || r_name || '</td></tr>', '' ORDER BY r_regionkey) AS h, count(*) AS n, min_by(r_name, r_regionkey) AS f FROM region),
          t AS (SELECT *, '| r_regionkey | r_name |' || chr(10) || '| --- | --- |' || chr(10) AS top FROM r)
          SELECT 'markdown' AS kind, top || m || chr(10) AS text FROM t UNION ALL SELECT 'html', '<!DOCTYPE html><title>Regions</title><table><tr><th>r_regionkey</th><th>r_name</th></tr>' || h || '</table>' FROM t UNION ALL SELECT 'short', top || '| 0 | ' || f || ' |' || chr(10) || chr(10) || (n - 1) || ' more rows' || chr(10) FROM t""",
        "ascii_hosts": "SELECT live_id, 'http://' || ['xn--bcher-kva.example', 'xn--fsqu00a.test', 'plain.test'][live_id % 3 + 1] || ':8080/' || regexp_replace(coalesce(url, ''), '(?s)^[A-Za-z]+://[^/?#]*', '') AS sent FROM lives",
        "archives": "SELECT n_name AS path, length(n_name) % 2 = 0 AS broken, CASE WHEN length(n_name) % 2 = 1 THEN 'a.json,z/' || n_name || '.txt' ELSE '' END AS entries, CASE WHEN length(n_name) % 2 = 1 THEN 'no-dex-entry' ELSE 'zip' END AS err, true AS no_classes FROM nation",
        "ratio_sample": "SELECT c_custkey FROM customer ORDER BY md5('seed2' || c_custkey), c_custkey LIMIT (SELECT greatest(1, count(*) // 20) FROM customer)",
        "streamed_verdicts": f"""WITH r AS (SELECT key, type AS p, {_RANK.format('level')} AS k, coalesce(total > 0, false) AS e, level, generated_at AS g, probe_id AS i FROM sites_probe WHERE key IS NOT NULL AND level IS NOT NULL)
          SELECT key, level FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY p DESC NULLS LAST, e DESC, CASE WHEN e THEN g END DESC NULLS LAST, CASE WHEN e THEN i END DESC NULLS LAST, k, g DESC, i DESC) AS n FROM r WHERE k < 6 OR e OR coalesce(p, -1) >= 4) WHERE n = 1""",
        "simplified_names": f"SELECT {NORMAL_NAME} AS form, count(*) AS n FROM lives WHERE name IS NOT NULL GROUP BY 1",
    }


SQL = _sql()
