"""Queries for joins, diffs, aggregates, deduplication, histories, state machines, labels and guards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heddle.functions import content, grades
from heddle.functions.names import norm_key, title_norm
from heddle.functions.urls import canonical_url, host_of, norm_api
from heddle.operators import dedup, history, joins, labels, mirrors, state
from heddle.runtime import table

#: The two snapshots that diffs compare, the day and moment that ages refer to.
BEFORE, AFTER, AS_OF = "2026-09-29", "2026-09-30", "2026-10-05"


def _snapshot(spark: SparkSession, d: str, day: str) -> DataFrame:
    """One row a key of a snapshot, the latest; ties by content."""
    t = table(spark, d, "interfaces").where((F.col("snapshot_date") == day) & F.col("key").rlike(r"\S"))
    keep = ["name", "api", "ext", "type", "health", "health_rank", "level", "latency_ms", "source", "fail_streak", "last_seen"]
    return history.latest(t, "key", ["updated_at", "api", "health", "level", "name"], keep)


def _latest_sql(day: str) -> str:
    return f"""(SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY updated_at DESC NULLS LAST, api DESC NULLS LAST, health DESC NULLS LAST, level DESC NULLS LAST, name DESC NULLS LAST) AS rn
      FROM interfaces WHERE snapshot_date = '{day}' AND regexp_matches(key, '\\S')) WHERE rn = 1)"""


_B, _A = _latest_sql(BEFORE), _latest_sql(AFTER)
_NK = "regexp_replace(lower(regexp_replace(coalesce(key, ''), '^\\s+|\\s+$', '', 'g')), '[\\s_\\-·•]+', '', 'g')"


# Joins and diffs


def enrich_left_lookup(spark: SparkSession, d: str) -> DataFrame:
    sites = table(spark, d, "sites").select("row_id", "key")
    return joins.lookup(sites, _snapshot(spark, d, AFTER), {"key": "key"}, "health", "unknown", "health")


def snapshot_field_diff(spark: SparkSession, d: str) -> DataFrame:
    return joins.field_diff(_snapshot(spark, d, BEFORE), _snapshot(spark, d, AFTER), key="key", fields=["name", "api", "level"])


def snapshot_diff_fallback_key(spark: SparkSession, d: str) -> DataFrame:
    fp = F.when(F.trim(F.coalesce("api", F.lit(""))) != "", F.concat(F.lit("api:"), F.trim("api"))).when(F.coalesce("ext", F.lit("")) != "", F.concat(F.lit("ext:"), F.substring("ext", 1, 80))).otherwise("")
    return joins.health_diff(_snapshot(spark, d, BEFORE), _snapshot(spark, d, AFTER), key="key", fingerprint=fp, health="health")


def unreferenced_anti(spark: SparkSession, d: str) -> DataFrame:
    part, line = table(spark, d, "part"), table(spark, d, "lineitem")
    lone = part.join(line.select(F.col("l_partkey").alias("p_partkey")), "p_partkey", "left_anti")
    return lone.groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("p_size").cast("long")).alias("size"))


def prune_semi(spark: SparkSession, d: str) -> DataFrame:
    dead = table(spark, d, "interfaces").where("health = 'dead'").select("key").distinct()
    return table(spark, d, "sites").join(dead, "key", "left_semi").groupBy("src").agg(F.count(F.lit(1)).alias("n"))


def or_match_first(spark: SparkSession, d: str) -> DataFrame:
    probes = table(spark, d, "sites_probe").select("probe_id", "key", "api")
    ref = _snapshot(spark, d, AFTER).withColumn("ckey", canonical_url(F.col("api")))
    return joins.first_match(probes, ref, [(F.col("key"), "key"), (canonical_url(F.col("api")), "ckey")], "level", "key", "found").select("probe_id", "found")


def cascade_match(spark: SparkSession, d: str) -> DataFrame:
    jars = table(spark, d, "sites").where("jar <> ''").select("jar").distinct()
    ref = table(spark, d, "sites").where("jar <> ''").select(F.regexp_extract("jar", r"^([^;]*)", 1).alias("file")).distinct()
    return joins.cascade_match(jars, ref, left="jar", right="file", length=6, name="file")


def forall_declared(spark: SparkSession, d: str) -> DataFrame:
    o = joins.all_match(table(spark, d, "lineitem"), group="l_orderkey", matched=F.col("l_shipdate") < "1997-01-01")
    return o.groupBy("all_matched").agg(F.count(F.lit(1)).alias("n"))


def union_supplement(spark: SparkSession, d: str) -> DataFrame:
    main = _snapshot(spark, d, AFTER).select("key", "level")
    more = history.latest(table(spark, d, "sites_probe").where("key is not null"), "key", ["generated_at", "probe_id"], ["level"])
    return joins.supplement(main, more, "key")


def carry_forward_merge(spark: SparkSession, d: str) -> DataFrame:
    return joins.carry_forward(_snapshot(spark, d, AFTER), _snapshot(spark, d, BEFORE), "key", ["health", "level", "ext"])


def pool_merge_max_new(spark: SparkSession, d: str) -> DataFrame:
    pool, fresh = _snapshot(spark, d, BEFORE), _snapshot(spark, d, AFTER)
    return joins.pool_merge(pool, fresh, key="key", history="fail_streak", order=["key"], most_new=20)


def upsert_improving(spark: SparkSession, d: str) -> DataFrame:
    cur = _snapshot(spark, d, AFTER).select("key", grades.level_rank(F.col("level")).alias("rank"))
    new = table(spark, d, "sites_probe").where("key is not null").select("key", grades.level_rank(F.col("level")).alias("rank"))
    return joins.improve_only(cur, new, key="key", rank="rank")


def reconcile_copies(spark: SparkSession, d: str) -> DataFrame:
    h = lambda day: _snapshot(spark, d, day).select("key", F.md5("api").alias("hash"))
    return joins.reconcile(h(BEFORE), h(AFTER), key="key", hash="hash").groupBy("verdict").agg(F.count(F.lit(1)).alias("n"))


def unfinished_jobs(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "events").where("event_id % 3 <> 0").select(F.when(F.col("event_type") == "view", F.concat(F.lit('{"k":'), "event_id")).otherwise(F.to_json(F.struct(F.col("event_id").alias("k")))).alias("line"))
    return joins.unfinished(table(spark, d, "events").select("event_id"), lines, key="event_id", line="line", field="k")


def reuse_or_probe(spark: SparkSession, d: str) -> DataFrame:
    sites, probes = table(spark, d, "sites").where("key is not null"), table(spark, d, "sites_probe").where("key is not null")
    out = joins.reuse_split(sites, probes, key="key", at="generated_at", ok="l1_ok", as_of="2026-09-28 12:00:00", hours=24)
    return out.groupBy("action").agg(F.count(F.lit(1)).alias("n"))


def forall_falsified(spark: SparkSession, d: str) -> DataFrame:
    o = joins.all_match(table(spark, d, "lineitem"), group="l_orderkey", matched=F.col("l_returnflag").isin("R", "A"))
    return o.where("all_matched").join(table(spark, d, "orders").where("o_orderstatus = 'O'").select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey", "left_anti").select("l_orderkey")


def shell_follow(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "mirror_groups").where("is_match and key is not null and peer_key is not null")  # either way, so in loops too
    return joins.follow(m, src="key", dst="peer_key", most=4)


# Aggregates


def health_distribution(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "interfaces").groupBy("snapshot_date", F.coalesce("health", F.lit("unknown")).alias("health")).agg(F.count(F.lit(1)).alias("n"))


def avail_ratio(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("value") > 50).alias("over"))
    return t.withColumn("share", F.try_divide(F.col("over"), F.col("n")))


def weighted_availability(spark: SparkSession, d: str) -> DataFrame:
    per = table(spark, d, "sites_probe").groupBy("key").agg(F.count("l1_ok").alias("n"), F.count_if("l1_ok").alias("ok"), F.max("total").alias("hi"), F.min("total").alias("lo"))
    per = per.withColumn("grade", F.when(F.col("n") == 0, "not-parsable").when(F.col("ok") == F.col("n"), "fully").when(F.col("ok") > 0, "partially").otherwise("unavailable"))
    drift = F.coalesce((F.col("hi") - F.col("lo")) * 10 > F.greatest("lo", F.lit(1)) * 3, F.lit(False))
    full, part, none = (F.count_if(F.col("grade") == g) for g in ("fully", "partially", "unavailable"))
    dr = F.count_if(drift)
    return per.agg(full.alias("fully"), part.alias("partially"), none.alias("unavailable"), dr.alias("drift"), F.try_divide(full * 10 + part * 5 + dr * 3, (full + part + none + dr) * 10).alias("availability"))


def regex_latency_avg(spark: SparkSession, d: str) -> DataFrame:
    from heddle.functions.names import latency_label

    return table(spark, d, "lives").groupBy("group_name").agg(F.avg(latency_label(F.col("name"))).alias("mean_ms"))


def norm_key_collisions(spark: SparkSession, d: str) -> DataFrame:
    return dedup.collisions(table(spark, d, "sites"), norm_key(F.col("key")), F.col("key"))


def title_token_topk(spark: SparkSession, d: str) -> DataFrame:
    words = table(spark, d, "documents").select(F.explode(F.split(F.lower(F.coalesce("text", F.lit(""))), r"[^\p{L}\p{N}]+")).alias("token")).where("token <> ''")
    top = words.groupBy("token").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "token").limit(50)
    return top.where("n >= 100")


def nested_histogram(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "lives").groupBy(host_of(F.col("url")).alias("host"), "health").agg(F.count(F.lit(1)).alias("n"))
    return joins.top_per(c, ["host"], [F.desc("n"), F.asc_nulls_last("health")], 6)


def metric_drop_alert(spark: SparkSession, d: str) -> DataFrame:
    days = table(spark, d, "interfaces").groupBy("snapshot_date").agg(F.count_if(F.col("health") == "healthy").alias("n"))
    from pyspark.sql import Window

    prev = F.lag("n").over(Window.orderBy("snapshot_date"))  # one row a snapshot
    return days.withColumn("prev", prev).select("snapshot_date", "n", F.coalesce((F.col("prev") > 0) & ((F.col("prev") - F.col("n")) * 100 > F.col("prev") * 5), F.lit(False)).alias("alert"))


def coverage_pct(spark: SparkSession, d: str) -> DataFrame:
    probed = table(spark, d, "sites_probe").select("key").distinct().withColumn("hit", F.lit(1))
    t = table(spark, d, "sites").join(probed, "key", "left").groupBy("type").agg(F.count(F.lit(1)).alias("n"), F.count("hit").alias("covered"))
    return t.withColumn("pct", F.col("covered") * 100 / F.col("n"))


def upper_median(spark: SparkSession, d: str) -> DataFrame:
    return history.upper_median(table(spark, d, "sites_probe"), "type", "ms")


def source_summary(spark: SparkSession, d: str) -> DataFrame:
    dead = table(spark, d, "interfaces").where("health = 'dead'").select("key").distinct().withColumn("dead", F.lit(True))
    t = table(spark, d, "sites").select("src", "key").join(dead, "key", "left")
    counts = t.groupBy("src").agg(F.count_if(F.col("dead").isNull()).alias("kept"), F.count_if("dead").alias("dropped"))
    first = joins.top_per(t.where("dead").select("src", "key").distinct(), ["src"], [F.asc("key")], 3)  # at most three a source
    sample = first.groupBy(F.col("src").alias("__src")).agg(F.array_join(F.array_sort(F.collect_list("key")), ",").alias("sample"))
    return counts.join(sample, F.col("src").eqNullSafe(F.col("__src")), "left").select("src", "kept", "dropped", F.coalesce("sample", F.lit("")).alias("sample"))


def set_union_refs(spark: SparkSession, d: str) -> DataFrame:
    a, b = table(spark, d, "sites").select("key"), table(spark, d, "sites_probe").select("key")
    tagged = a.distinct().withColumn("s", F.lit(1)).unionByName(b.distinct().withColumn("s", F.lit(2)))
    return tagged.where("key is not null").groupBy("key").agg(F.sum("s").alias("s")).groupBy(F.when(F.col("s") == 3, "both").when(F.col("s") == 1, "sites").otherwise("probes").alias("side")).agg(F.count(F.lit(1)).alias("n"))


def set_symdiff(spark: SparkSession, d: str) -> DataFrame:
    dead = table(spark, d, "interfaces").where("health = 'dead' and key is not null")
    return joins.symmetric_count(dead.select("source", "key"), dead.where(F.col("snapshot_date") == AFTER).select("source", "key"), by="source", item="key").select("source", F.col("n").cast("int"))


# Deduplication


def first_wins_dedup(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "sites").select("row_id", "type", "api", "jar")
    return dedup.first_wins(t, [F.col("type"), norm_api(F.col("api")), F.coalesce("jar", F.lit(""))], ["row_id"]).select("row_id")


def key_dedup_rename(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "sites").select("row_id", "key", "api")
    return dedup.rename_keys(t, key="key", api="api", order=["row_id"]).select("row_id", "new_key")


def name_dedup_best(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "sites").select("row_id", "name", "key", "origin", "searchable", "quick_search", "api")
    out = dedup.name_best(t, name="name", key="key", origin="origin", searchable="searchable", quick="quick_search", api="api", order=["row_id"])
    return out.select("row_id", "shown_name")


def lives_dedup(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "lives").where(F.trim(F.coalesce("url", F.lit(""))) != "").select("live_id", "name", "url")
    return dedup.first_wins(t, [title_norm(F.col("name")), F.trim("url")], ["live_id"]).select("live_id")


def content_hash_dups(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "documents").select("doc_id", "text", "n_chars")
    return dedup.content_groups(t, content=F.col("text"), size=F.col("n_chars"), order="doc_id", whole=F.col("text").isNotNull())


def casefold_collisions(spark: SparkSession, d: str) -> DataFrame:
    return dedup.case_collisions(table(spark, d, "sites").select(F.concat(F.lit("deps/"), "key", F.lit(".json")).alias("path")), path="path")


def minhash_sketch(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "sites_probe").select("probe_id", mirrors.title_set(F.col("names")).alias("t")).where(F.size("t") >= 5)
    s = mirrors.sketch(F.col("t"))
    return t.select("probe_id", F.size(s).alias("size"), F.array_join(F.transform(s, lambda x: x.cast("string")), ",").alias("sketch"))


def _mirror_pairs(spark: SparkSession, d: str) -> DataFrame:
    return mirrors.mirror_pairs(table(spark, d, "sites_probe").where("l1_ok"), id="probe_id", type="type", titles="names", total="total", api="api")


def near_dup_pairs(spark: SparkSession, d: str) -> DataFrame:
    return _mirror_pairs(spark, d)


def near_dup_components(spark: SparkSession, d: str) -> DataFrame:
    return mirrors.components(_mirror_pairs(spark, d))


def mirror_keepers(spark: SparkSession, d: str) -> DataFrame:
    """The best member of each cluster of mirrors: best level, least ms, least id."""
    c = mirrors.components(_mirror_pairs(spark, d))
    p = table(spark, d, "sites_probe").select(F.col("probe_id").alias("id"), grades.level_rank(F.col("level")).alias("r"), F.coalesce("ms", F.lit(99999)).alias("ms"))
    return c.join(p, "id").groupBy("root").agg(F.min_by("id", F.struct("r", "ms", "id")).alias("keep"), F.count(F.lit(1)).alias("members"))


# Histories


def last_n_gate(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("user_id", "event_id", "ts", F.when(F.col("event_type") != "view", F.col("value") > 20).alias("good"), (F.col("value") > 99).alias("big"))
    return history.gate(e, by="user_id", success="good", order=[F.desc("ts"), F.desc("event_id")], days=7, max_failures=1, label=F.col("big"))


def fail_streak(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "interfaces").where("key is not null").withColumn("o", F.struct("updated_at", F.coalesce("health", F.lit(""))))
    return history.fail_streak(t, by="key", day="snapshot_date", failed=F.coalesce(F.col("health") == "dead", F.lit(False)), order="o", as_of="2026-10-01")


def decay_stage(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "interfaces").where("key is not null")
    return history.decay_stage(t, by="key", day="snapshot_date", ok=F.coalesce(F.col("health").isin("healthy", "degraded"), F.lit(False)))


def slot_mod3(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import Window

    n = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")) - 1
    e = table(spark, d, "events").select("event_type", (n % 3).alias("slot"))
    return e.groupBy("slot", "event_type").agg(F.count(F.lit(1)).alias("n"))


def latest_by_key(spark: SparkSession, d: str) -> DataFrame:
    return history.latest(table(spark, d, "events"), "user_id", ["ts", "event_id"], ["event_id", "event_type"])


def ring_keep_n(spark: SparkSession, d: str) -> DataFrame:
    return history.last_n(table(spark, d, "interfaces").where("key is not null").select("key", "snapshot_date", "updated_at").distinct(), "key", [F.desc("snapshot_date"), F.desc("updated_at")], 3).select("key", "snapshot_date", "rank_from_last")


def enum_rank_sort_topk(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "sites_probe").select("probe_id", grades.level_rank(F.col("level")).alias("rank"), F.coalesce("ms", F.lit(99999)).alias("ms"))
    return t.orderBy("rank", "ms", "probe_id").limit(50)


def rotating_window(spark: SparkSession, d: str) -> DataFrame:
    return history.rotation_window(table(spark, d, "customer"), key="c_custkey", day="2026-10-14", width=100)


def hash_sample(spark: SparkSession, d: str) -> DataFrame:
    return history.hash_sample(table(spark, d, "customer").select("c_custkey"), "c_custkey", "seed1", 100)


# State machines


def ingest_transitions(spark: SparkSession, d: str) -> DataFrame:
    h = F.md5(F.concat_ws("|", F.coalesce("api", F.lit("")), F.coalesce("health", F.lit(""))))
    prev = _snapshot(spark, d, BEFORE).select("key", h.alias("h"), F.coalesce(F.col("health") == "dead", F.lit(False)).alias("gone"))
    return state.ingest_transitions(prev, _snapshot(spark, d, AFTER).select("key", h.alias("h")), key="key", hash="h", deleted="gone").groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def stale_prune(spark: SparkSession, d: str) -> DataFrame:
    return state.stale_prune(_snapshot(spark, d, AFTER), key="key", seen="last_seen", as_of=AS_OF, grace=4)


def size_tier_grace(spark: SparkSession, d: str) -> DataFrame:
    files = table(spark, d, "documents").select("doc_id", (F.col("n_chars") * 1024).alias("size"), F.coalesce(F.col("lang") == "zh", F.lit(False)).alias("used"))
    seen = table(spark, d, "documents").where("posted_at is not null and doc_id % 2 = 0").select("doc_id", F.to_date("posted_at").alias("first_seen"))
    return state.two_phase_gc(files, seen, path="doc_id", referenced="used", size="size", first_seen="first_seen", as_of=AS_OF)


def ledger_ghosts(spark: SparkSession, d: str) -> DataFrame:
    ledger = _snapshot(spark, d, AFTER).select("key", F.col("fail_streak").alias("refs"), "last_seen")
    return state.ghost_rows(ledger, table(spark, d, "sites_probe"), path="key", refs="refs", updated="last_seen", as_of=AS_OF, idle=5).select("key")


def verdict_fold(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "sites_probe").where("key is not null and level is not null")
    rows = p.select("key", F.col("type").alias("priority"), grades.level_rank(F.col("level")).alias("rank"), F.coalesce(F.col("total") > 0, F.lit(False)).alias("evidence"), "level", F.struct("generated_at", "probe_id").alias("at"))
    return state.fold_verdicts(rows, key="key", priority="priority", rank="rank", evidence="evidence", level="level", at="at")


def snapshot_retraction(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "sites_probe").select("probe_id", F.col("type").cast("string").alias("probe"), "generated_at")
    return state.retract_snapshot(p, probe="probe", batch="generated_at", snapshot_probes=["1", "3"]).select("probe_id")


def backoff_reuse(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "interfaces").where("key is not null").select("key", F.when(F.col("health") == "healthy", "ok").otherwise("fail").alias("status"), "snapshot_date")
    return state.backoff(t, key="key", status="status", day="snapshot_date", as_of=AS_OF, wait=8, ttl=12).groupBy("action").agg(F.count(F.lit(1)).alias("n"))


def static_merge(spark: SparkSession, d: str) -> DataFrame:
    ex = _snapshot(spark, d, AFTER).where("level is not null")
    v = history.latest(table(spark, d, "sites_probe").where("key is not null"), "key", ["generated_at", "probe_id"], ["level", "l1_ok"]).where("level is not null")
    return state.static_merge(ex, v.withColumn("l1_ok", F.coalesce("l1_ok", F.lit(False))), key="key", level="level", evidence="l1_ok")


def change_log(spark: SparkSession, d: str) -> DataFrame:
    return state.change_log(_snapshot(spark, d, BEFORE), _snapshot(spark, d, AFTER), key="key", hash=content.canonical_hash("api", "health", "level"))


# Labels and guards


def min_rank_floor(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "interfaces")
    return t.where(grades.health_rank(F.col("health")) <= 1).groupBy("snapshot_date").agg(F.count(F.lit(1)).alias("n"))


def _keywords(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([("体育", "sport", 1), ("news", "news", 2), ("新闻", "news", 2), ("kino", "film", 3), ("电影", "film", 3), ("hd", "quality", 9)], "keyword string, reason string, priority int")


def vocab_label(spark: SparkSession, d: str) -> DataFrame:
    allow = spark.createDataFrame([("少儿",), ("kids",)], "keyword string")
    return labels.label(table(spark, d, "lives"), _keywords(spark), id="live_id", text=F.coalesce("name", F.lit("")), allow=allow)


def quarantine_split(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "lives").select("live_id", "name", "group_name")
    clean, hits = labels.quarantine(t, labels.label(t, _keywords(spark), id="live_id", text=F.coalesce("name", F.lit(""))), "live_id")
    both = clean.select("group_name", F.lit("clean").alias("part")).unionByName(hits.select("group_name", F.lit("hits").alias("part")))
    return both.groupBy("group_name", "part").agg(F.count(F.lit(1)).alias("n"))


def any_alive(spark: SparkSession, d: str) -> DataFrame:
    return labels.any_alive(table(spark, d, "sites_probe").where("key is not null"), by="key", ok="l1_ok")


def longtail_prune(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "lives").where("name is not null").select("name", "url", (F.col("health") == "healthy").alias("ok"), "group_name")
    return labels.longtail(t, by="name", line="url", verified="ok", cls="group_name", prune_class="其他", exempt=F.col("name").contains("音乐"))


def prune_blocks(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("user_id", "event_id", "event_type", "value")
    e = history.block_ids(e, by=["user_id"], order="event_id", starts=F.col("event_type") == "view")
    return labels.prune_blocks(e, block=["user_id", "block"], head=F.col("event_type") == "view", dead=F.coalesce(F.col("value") < 60, F.lit(False))).select("event_id")


def dead_disposition(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "lives").where("health = 'dead'")
    return t.groupBy(labels.dispose_dead(F.col("url"), F.coalesce(F.col("channels") > 20, F.lit(False))).alias("action")).agg(F.count(F.lit(1)).alias("n"))


def guard_report(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "interfaces").select("health", F.when(F.col("level") == "E0", 0).when(F.col("level").isNull(), 403).otherwise(200).alias("code"))
    return labels.guards(t, code="code", ok=F.coalesce(F.col("health") != "dead", F.lit(False)), healthy=F.coalesce(F.col("health") == "healthy", F.lit(False)))


def tool_failure_guard(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "interfaces").where("source is not null")
    return labels.tool_failure(t, by=["source", "snapshot_date"], ok=F.col("health").isin("healthy", "degraded"), message=F.coalesce("health", F.lit("unknown")), pattern="unknown")


def audited_links(spark: SparkSession, d: str) -> DataFrame:
    """Addresses in JSON fields, without those under an exempted path."""
    from heddle.sources.documents import json_urls

    found = json_urls(table(spark, d, "sites"), id="row_id", column="ext")
    return found.where(~labels.exempt(F.col("json_path"), [r"^\$\.note", r"\.audit\b"])).groupBy("json_path").agg(F.count(F.lit(1)).alias("n"))


def fail_limits(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "interfaces").where("key is not null")
    kind = F.when(F.col("level") == "E0", "404").when(F.col("level") == "S0", "timeout").otherwise("5xx")
    return t.where(F.col("fail_streak") >= grades.fail_limit(kind)).groupBy("snapshot_date").agg(F.count(F.lit(1)).alias("n"))


_FUNCTIONS = [v for k, v in list(globals().items()) if callable(v) and getattr(v, "__module__", "") == __name__ and not k.startswith("_")]
QUERIES = {f.__name__: f for f in _FUNCTIONS}

from heddle.plans.tables_sql import make_sql  # noqa: E402

SQL = make_sql(_B, _A, _NK, AS_OF)
