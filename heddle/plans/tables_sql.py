"""DuckDB's SQL for the table queries."""

from __future__ import annotations

_RANK = "CASE {0} WHEN 'L3' THEN 0 WHEN 'L2' THEN 1 WHEN 'L1' THEN 2 WHEN 'L?' THEN 3 WHEN 'L0' THEN 4 WHEN 'S1' THEN 5 WHEN 'S0' THEN 6 ELSE 7 END"
_TITLES = "lower(regexp_replace(coalesce({0}, ''), '[^\\p{{L}}\\p{{N}}]+', '', 'g'))"
_HOST = "lower(regexp_extract(regexp_replace(coalesce({0}, ''), '^\\s+|\\s+$', '', 'g'), '^[A-Za-z][A-Za-z0-9+.\\-]*://(?:[^/?#@]*@)?([^/?#]*)', 1))"
_SETS = f"""t AS (SELECT probe_id, type, total, {_HOST.format('api')} AS host, list_sort(list_distinct(list_filter(list_transform(coalesce(names, []), lambda x: {_TITLES.format('x')}), lambda x: x <> ''))) AS s FROM sites_probe {{where}}),
  z AS (SELECT * FROM t WHERE len(s) >= 5)"""
_PAIRS = (
    _SETS.replace("{where}", "WHERE l1_ok")
    + """, w AS (SELECT probe_id, type, unnest(s) AS x FROM z),
  c AS (SELECT a.probe_id AS a, b.probe_id AS b, count(*) AS c FROM w a JOIN w b ON a.type = b.type AND a.x = b.x AND a.probe_id < b.probe_id GROUP BY ALL),
  p AS (SELECT c.a, c.b, c.c, len(x.s) + len(y.s) - c.c AS u, x.host AS ha, y.host AS hb, x.total AS na, y.total AS nb FROM c JOIN z x ON x.probe_id = c.a JOIN z y ON y.probe_id = c.b),
  pairs AS (SELECT a, b, CASE WHEN c * 10 >= u * 8 AND CASE WHEN coalesce(na, 0) <> 0 AND coalesce(nb, 0) <> 0 THEN abs(na - nb) * 100 <= greatest(na, nb) * 15 ELSE true END THEN 'library'
    WHEN ha <> hb AND c * 10 >= u * 5 THEN 'function' END AS rule FROM p)"""
)
_COMP = (
    _PAIRS
    + """, e AS (SELECT a, b FROM pairs WHERE rule IS NOT NULL UNION SELECT b, a FROM pairs WHERE rule IS NOT NULL),
  walk(id, low) AS (SELECT a, a FROM e UNION SELECT e.b, w.low FROM walk w JOIN e ON e.a = w.id), comp AS (SELECT id, min(low) AS root FROM walk GROUP BY id)"""
)
_LABEL = "CASE WHEN contains(t, '体育') THEN 'sport' WHEN contains(t, 'news') THEN 'news' WHEN contains(t, '新闻') THEN 'news' WHEN contains(t, 'kino') THEN 'film' WHEN contains(t, '电影') THEN 'film' WHEN contains(t, 'hd') THEN 'quality' END"


def make_sql(b: str, a: str, nk: str, as_of: str) -> dict[str, str]:
    """``b`` and ``a`` are the deduplicated earlier and later snapshots."""
    from heddle.plans.scalars import _U, _canonical

    u = _U.format("api")
    na = f"lower(CASE WHEN regexp_matches({u}, '^(?i)https?://') THEN {_canonical('api')} ELSE {u} END)"
    fp = "CASE WHEN trim(coalesce(api, '')) <> '' THEN 'api:' || trim(api) WHEN coalesce(ext, '') <> '' THEN 'ext:' || substr(ext, 1, 80) ELSE '' END"
    days = f"date_diff('day', CAST(snapshot_date AS DATE), DATE '{as_of}')"
    return {
        "enrich_left_lookup": f"SELECT row_id, s.key, coalesce(a.health, 'unknown') AS health FROM sites s LEFT JOIN {a} a ON a.key = s.key",
        "snapshot_field_diff": f"""SELECT coalesce(a.key, b.key) AS key, CASE WHEN b.key IS NULL THEN 'added' WHEN a.key IS NULL THEN 'removed' ELSE 'modified' END AS status,
          CASE WHEN a.key IS NULL OR b.key IS NULL THEN '' ELSE concat_ws(',', CASE WHEN a.name IS DISTINCT FROM b.name THEN 'name' END, CASE WHEN a.api IS DISTINCT FROM b.api THEN 'api' END, CASE WHEN a.level IS DISTINCT FROM b.level THEN 'level' END) END AS changed
          FROM {a} a FULL JOIN {b} b ON a.key = b.key WHERE a.key IS NULL OR b.key IS NULL OR a.name IS DISTINCT FROM b.name OR a.api IS DISTINCT FROM b.api OR a.level IS DISTINCT FROM b.level""",
        "snapshot_diff_fallback_key": f"""WITH p AS (SELECT key, {fp} AS f, coalesce(health, 'unknown') AS h FROM {b}), c AS (SELECT key, {fp} AS f, coalesce(health, 'unknown') AS h FROM {a}),
          pf AS (SELECT f, arg_min(h, key) AS h FROM p WHERE f <> '' GROUP BY f), j AS (SELECT c.key, c.h, coalesce(pf.h, p.h) AS o FROM c LEFT JOIN pf ON pf.f = c.f LEFT JOIN p ON p.key = c.key)
          SELECT * FROM (SELECT key, CASE WHEN o IS NULL THEN 'new' WHEN o IN ('healthy', 'degraded') AND h = 'dead' THEN 'down' WHEN o = 'dead' AND h IN ('healthy', 'degraded') THEN 'recovered' END AS change FROM j) WHERE change IS NOT NULL
          UNION ALL SELECT key, 'gone' FROM p WHERE key NOT IN (SELECT key FROM c) AND f NOT IN (SELECT f FROM c WHERE f <> '')""",
        "unreferenced_anti": "SELECT p_brand, count(*) AS n, sum(p_size)::BIGINT AS size FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem) GROUP BY p_brand",
        "prune_semi": "SELECT src, count(*) AS n FROM sites WHERE key IN (SELECT key FROM interfaces WHERE health = 'dead' AND key IS NOT NULL) GROUP BY src",
        "or_match_first": f"""WITH r AS (SELECT key, level, {_canonical('api')} AS ck FROM {a}), k AS (SELECT key, arg_min(level, key) AS level FROM r GROUP BY key), c AS (SELECT ck, arg_min(level, key) AS level FROM r WHERE ck IS NOT NULL GROUP BY ck),
          p AS (SELECT probe_id, key, {_canonical('api')} AS ck FROM sites_probe) SELECT probe_id, coalesce(k.level, c.level) AS found FROM p LEFT JOIN k ON k.key = p.key LEFT JOIN c ON c.ck = p.ck""",
        "cascade_match": """WITH j AS (SELECT DISTINCT jar FROM sites WHERE jar <> ''), r AS (SELECT DISTINCT regexp_extract(jar, '^([^;]*)', 1) AS f FROM sites WHERE jar <> '')
          SELECT jar, min(f) AS file FROM j LEFT JOIN (SELECT * FROM r WHERE length(f) >= 6) r ON starts_with(jar, f) OR starts_with(f, jar) GROUP BY jar""",
        "forall_declared": "SELECT all_matched, count(*) AS n FROM (SELECT l_orderkey, bool_and(coalesce(l_shipdate < TIMESTAMP '1997-01-01', false)) AS all_matched FROM lineitem GROUP BY 1) GROUP BY 1",
        "union_supplement": f"""WITH m AS (SELECT key, level FROM {a}), p AS (SELECT key, level FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY generated_at DESC NULLS LAST, probe_id DESC) AS n FROM sites_probe WHERE key IS NOT NULL) WHERE n = 1)
          SELECT * FROM m UNION ALL SELECT * FROM p WHERE key NOT IN (SELECT key FROM m)""",
        "carry_forward_merge": f"SELECT coalesce(a.key, b.key) AS key, coalesce(a.health, b.health) AS health, coalesce(a.level, b.level) AS level, coalesce(a.ext, b.ext) AS ext FROM {a} a FULL JOIN {b} b ON a.key = b.key",
        "pool_merge_max_new": f"""WITH p AS (SELECT * FROM {b}), f AS (SELECT * FROM {a}) SELECT key, 'kept' AS state FROM p WHERE key IN (SELECT key FROM f)
          UNION ALL SELECT key, 'vanished' FROM p WHERE key NOT IN (SELECT key FROM f) AND coalesce(fail_streak, 0) > 0 UNION ALL SELECT * FROM (SELECT key, 'new' FROM f WHERE key NOT IN (SELECT key FROM p) ORDER BY key LIMIT 20)""",
        "upsert_improving": f"SELECT coalesce(c.key, n.key) AS key, least(c.r, n.r) AS rank FROM (SELECT key, {_RANK.format('level')} AS r FROM {a}) c FULL JOIN (SELECT key, min({_RANK.format('level')}) AS r FROM sites_probe WHERE key IS NOT NULL GROUP BY key) n ON c.key = n.key",
        "reconcile_copies": f"""SELECT CASE WHEN a.key IS NULL THEN 'missing' WHEN b.key IS NULL THEN 'extra' WHEN a.api IS NULL THEN 'unread' WHEN a.api = b.api THEN 'ok' ELSE 'mismatch' END AS verdict, count(*) AS n FROM {b} b FULL JOIN {a} a ON a.key = b.key GROUP BY 1""",
        "unfinished_jobs": "SELECT event_id FROM events WHERE event_id % 3 = 0 OR event_type = 'view'",
        "reuse_or_probe": """WITH d AS (SELECT key, max(generated_at) FILTER (l1_ok) AS at FROM sites_probe WHERE key IS NOT NULL GROUP BY key)
          SELECT CASE WHEN d.at > TIMESTAMP '2026-09-27 12:00:00' THEN 'reuse' ELSE 'probe' END AS action, count(*) AS n FROM (SELECT DISTINCT key FROM sites WHERE key IS NOT NULL) s LEFT JOIN d USING (key) GROUP BY 1""",
        "forall_falsified": "SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING bool_and(coalesce(l_returnflag IN ('R', 'A'), false)) AND l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O')",
        "shell_follow": """WITH RECURSIVE e AS (SELECT DISTINCT key AS s, peer_key AS t FROM mirror_groups WHERE is_match AND key <> peer_key), w(src, dst, depth) AS (SELECT s, t, 1 FROM e UNION SELECT w.src, e.t, w.depth + 1 FROM w JOIN e ON e.s = w.dst WHERE w.depth < 4 AND w.src <> e.t)
          SELECT src, dst, min(depth) AS depth FROM w GROUP BY 1, 2""",
        "health_distribution": "SELECT snapshot_date, coalesce(health, 'unknown') AS health, count(*) AS n FROM interfaces GROUP BY 1, 2",
        "avail_ratio": "SELECT event_type, count(*) AS n, count(*) FILTER (value > 50) AS \"over\", count(*) FILTER (value > 50)::DOUBLE / count(*) AS share FROM events GROUP BY 1",
        "weighted_availability": """WITH p AS (SELECT key, count(l1_ok) AS n, count(*) FILTER (l1_ok) AS ok, max(total) AS hi, min(total) AS lo FROM sites_probe GROUP BY key),
          g AS (SELECT CASE WHEN n = 0 THEN 'not-parsable' WHEN ok = n THEN 'fully' WHEN ok > 0 THEN 'partially' ELSE 'unavailable' END AS g, coalesce((hi - lo) * 10 > greatest(lo, 1) * 3, false) AS d FROM p),
          c AS (SELECT count(*) FILTER (g = 'fully') AS fully, count(*) FILTER (g = 'partially') AS partially, count(*) FILTER (g = 'unavailable') AS unavailable, count(*) FILTER (d) AS drift FROM g)
          SELECT *, (fully * 10 + partially * 5 + drift * 3)::DOUBLE / ((fully + partially + unavailable + drift) * 10) AS availability FROM c""",
        "regex_latency_avg": "SELECT group_name, avg(TRY_CAST(nullif(regexp_extract(name, '\\[(\\d{1,9})ms', 1), '') AS INT)) AS mean_ms FROM lives GROUP BY 1",
        "norm_key_collisions": f"""WITH p AS (SELECT {nk} AS canonical, lower(regexp_replace(key, '/+$', '')) AS raw, count(*) AS n FROM sites GROUP BY 1, 2) SELECT canonical, count(*) AS spellings, sum(n)::BIGINT AS n_rows FROM p WHERE canonical <> '' GROUP BY 1 HAVING count(*) >= 2""",
        "title_token_topk": """SELECT * FROM (SELECT token, count(*) AS n FROM (SELECT unnest(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+')) AS token FROM documents) WHERE token <> '' GROUP BY 1 ORDER BY n DESC, token LIMIT 50) WHERE n >= 100""",
        "nested_histogram": f"""SELECT host, health, n FROM (SELECT *, row_number() OVER (PARTITION BY host ORDER BY n DESC, health ASC NULLS LAST) AS r FROM (SELECT {_HOST.format('url')} AS host, health, count(*) AS n FROM lives GROUP BY 1, 2)) WHERE r <= 6""",
        "metric_drop_alert": "WITH d AS (SELECT snapshot_date, count(*) FILTER (health = 'healthy') AS n FROM interfaces GROUP BY 1), p AS (SELECT *, lag(n) OVER (ORDER BY snapshot_date) AS p FROM d) SELECT snapshot_date, n, coalesce(p > 0 AND (p - n) * 100 > p * 5, false) AS alert FROM p",
        "coverage_pct": "WITH c AS (SELECT type, count(*) AS n, count(p.key) AS covered FROM sites s LEFT JOIN (SELECT DISTINCT key FROM sites_probe) p ON p.key = s.key GROUP BY 1) SELECT *, covered * 100::DOUBLE / n AS pct FROM c",
        "upper_median": "SELECT type, list_sort(list(ms))[(count(*) // 2 + 1)::INT] AS median FROM sites_probe WHERE ms IS NOT NULL GROUP BY 1",
        "source_summary": """WITH d AS (SELECT DISTINCT key FROM interfaces WHERE health = 'dead') SELECT src, count(*) FILTER (d.key IS NULL) AS kept, count(d.key) AS dropped, coalesce(array_to_string(list_sort(list(DISTINCT d.key) FILTER (d.key IS NOT NULL))[1:3], ','), '') AS sample
          FROM sites s LEFT JOIN d ON d.key = s.key GROUP BY 1""",
        "set_union_refs": """WITH a AS (SELECT DISTINCT key FROM sites WHERE key IS NOT NULL), b AS (SELECT DISTINCT key FROM sites_probe WHERE key IS NOT NULL)
          SELECT CASE WHEN a.key IS NOT NULL AND b.key IS NOT NULL THEN 'both' WHEN b.key IS NULL THEN 'sites' ELSE 'probes' END AS side, count(*) AS n FROM a FULL JOIN b ON a.key = b.key GROUP BY 1""",
        "set_symdiff": "SELECT source, (count(DISTINCT key) - count(DISTINCT key) FILTER (snapshot_date = '2026-09-30'))::INT AS n FROM interfaces WHERE health = 'dead' GROUP BY 1",
        "first_wins_dedup": f"SELECT min(row_id) AS row_id FROM sites GROUP BY type, {na}, coalesce(jar, '')",
        "key_dedup_rename": f"""WITH r AS (SELECT row_id, key, {nk} AS nk, {na} AS na FROM sites), f AS (SELECT nk, na, min(row_id) AS row_id, arg_min(key, row_id) AS key FROM r WHERE nk <> '' GROUP BY 1, 2),
          k AS (SELECT *, row_number() OVER (PARTITION BY nk ORDER BY row_id) AS n FROM f) SELECT row_id, CASE WHEN n = 1 THEN key ELSE nk || '-' || n END AS new_key FROM k""",
        "name_dedup_best": """WITH r AS (SELECT row_id, name, CASE WHEN coalesce(origin, '') <> '' THEN substr(regexp_replace(split_part(origin, '/', -1), '^\\d+-', ''), 1, 12) WHEN coalesce(key, '') <> '' THEN substr(key, 1, 8) ELSE 'unk' END AS tag,
          (CASE WHEN regexp_matches(coalesce(name, ''), '\\[\\d+ms') THEN 10 ELSE 0 END + CASE WHEN searchable = 1 THEN 5 ELSE 0 END + CASE WHEN quick_search = 1 THEN 3 ELSE 0 END + CASE WHEN coalesce(api, '') <> '' THEN 2 ELSE 0 END) AS score FROM sites),
          k AS (SELECT *, row_number() OVER (PARTITION BY name, tag ORDER BY score DESC, row_id) AS n, count(*) OVER (PARTITION BY name, tag) AS c FROM r), t AS (SELECT name, count(DISTINCT tag) AS tags FROM r GROUP BY 1)
          SELECT row_id, CASE WHEN tags > 1 AND c = 1 THEN coalesce(k.name, '') || '[' || tag || ']' ELSE k.name END AS shown_name FROM k JOIN t ON t.name IS NOT DISTINCT FROM k.name WHERE n = 1""",
        "lives_dedup": f"SELECT min(live_id) AS live_id FROM lives WHERE trim(coalesce(url, '')) <> '' GROUP BY {_TITLES.format('name')}, trim(url)",
        "content_hash_dups": "SELECT md5(text) AS hash, count(*) AS copies, (sum(n_chars) - arg_min(n_chars, doc_id))::BIGINT AS savable FROM documents WHERE text IS NOT NULL GROUP BY 1 HAVING count(*) > 1",
        "casefold_collisions": """WITH p AS (SELECT DISTINCT 'deps/' || key || '.json' AS path FROM sites), g AS (SELECT lower(path) AS f, min(path) AS first FROM p GROUP BY 1 HAVING count(*) > 1)
          SELECT path, regexp_extract(path, '^(.*?)(\\.[^./]*)?$', 1) || '~' || substr(md5(path), 1, 6) || '.json' AS new_path FROM p JOIN g ON g.f = lower(path) WHERE path <> first""",
        "minhash_sketch": f"""WITH {_SETS.replace('{where}', '')}, h AS (SELECT probe_id, list_sort(list_distinct(list_transform(s, lambda x: (('0x' || substr(md5(x), 1, 12))::BIGINT % 4294967296))))[1:64] AS k FROM z)
          SELECT probe_id, len(k)::INT AS size, array_to_string(k, ',') AS sketch FROM h""",
        "near_dup_pairs": f"WITH {_PAIRS} SELECT a, b, rule FROM pairs WHERE rule IS NOT NULL",
        "near_dup_components": f"WITH RECURSIVE {_COMP} SELECT id, root FROM comp",
        "mirror_keepers": f"WITH RECURSIVE {_COMP} SELECT DISTINCT root, first_value(id) OVER (PARTITION BY root ORDER BY {_RANK.format('level')}, coalesce(ms, 99999), id) AS keep, count(*) OVER (PARTITION BY root) AS members FROM comp JOIN sites_probe ON probe_id = id",
        "last_n_gate": """WITH e AS (SELECT user_id, event_id, ts, CASE WHEN event_type <> 'view' THEN value > 20 END AS good, value > 99 AS big FROM events), r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM e WHERE good IS NOT NULL),
          s AS (SELECT user_id, count(*) AS n, count(*) FILTER (NOT good) AS f FROM r WHERE n <= 7 GROUP BY 1), m AS (SELECT user_id, bool_or(big) AS l FROM e GROUP BY 1),
          q AS (SELECT m.user_id, CASE WHEN l THEN 'label' WHEN coalesce(s.n, 0) < 7 THEN 'days' WHEN f > 1 THEN 'failures' ELSE '' END AS reason FROM m LEFT JOIN s USING (user_id)) SELECT user_id, reason = '' AS admitted, reason FROM q""",
        "fail_streak": """WITH d AS (SELECT key, snapshot_date, arg_max(coalesce(health = 'dead', false), (updated_at, coalesce(health, ''))) AS bad FROM interfaces WHERE key IS NOT NULL AND snapshot_date < '2026-10-01' GROUP BY 1, 2),
          g AS (SELECT key, max(snapshot_date) FILTER (NOT bad) AS g FROM d GROUP BY 1) SELECT key, count(*) FILTER (bad AND (g IS NULL OR snapshot_date > g)) AS streak FROM d JOIN g USING (key) GROUP BY 1""",
        "decay_stage": """WITH d AS (SELECT key, snapshot_date, bool_or(coalesce(health IN ('healthy', 'degraded'), false)) AS ok FROM interfaces WHERE key IS NOT NULL GROUP BY 1, 2), g AS (SELECT key, max(snapshot_date) FILTER (ok) AS g FROM d GROUP BY 1),
          s AS (SELECT key, count(*) FILTER (NOT ok AND (g IS NULL OR snapshot_date > g)) AS streak FROM d JOIN g USING (key) GROUP BY 1) SELECT *, CASE WHEN streak >= 7 THEN 'out' WHEN streak >= 3 THEN 'watch' ELSE 'active' END AS stage FROM s""",
        "slot_mod3": "SELECT slot::INT AS slot, event_type, count(*) AS n FROM (SELECT event_type, (row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1) % 3 AS slot FROM events) GROUP BY 1, 2",
        "latest_by_key": "SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1",
        "ring_keep_n": "SELECT key, snapshot_date, n::INT AS rank_from_last FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY snapshot_date DESC, updated_at DESC) AS n FROM (SELECT DISTINCT key, snapshot_date, updated_at FROM interfaces WHERE key IS NOT NULL)) WHERE n <= 3",
        "enum_rank_sort_topk": f"SELECT probe_id, {_RANK.format('level')} AS rank, coalesce(ms, 99999) AS ms FROM sites_probe ORDER BY rank, ms, probe_id LIMIT 50",
        "rotating_window": """WITH RECURSIVE n AS (SELECT count(*) AS n FROM customer), f(i, a) AS (SELECT 0, 0::BIGINT UNION ALL SELECT i + 1, (a * 65536 + ('0x' || substr(md5('2026-10-14'), i * 4 + 1, 4))::BIGINT) % n FROM f, n WHERE i < 8),
          r AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) - 1 AS r FROM customer) SELECT c_custkey FROM r, n, f WHERE i = 8 AND (r - a + n) % n < 100""",
        "hash_sample": "SELECT c_custkey FROM customer ORDER BY md5('seed1' || c_custkey), c_custkey LIMIT 100",
        "ingest_transitions": f"""WITH p AS (SELECT key, coalesce(api, '') || '|' || coalesce(health, '') AS h, coalesce(health = 'dead', false) AS d FROM {b}), c AS (SELECT key, coalesce(api, '') || '|' || coalesce(health, '') AS h FROM {a})
          SELECT CASE WHEN p.key IS NULL THEN 'new' WHEN c.key IS NULL THEN CASE WHEN d THEN 'gone' ELSE 'deleted' END WHEN d THEN CASE WHEN c.h = p.h THEN 'restored' ELSE 'changed_recovered' END WHEN c.h = p.h THEN 'unchanged' ELSE 'changed' END AS status, count(*) AS n
          FROM p FULL JOIN c ON c.key = p.key GROUP BY 1""",
        "stale_prune": f"SELECT DISTINCT key FROM {a} WHERE date_diff('day', TRY_CAST(nullif(trim(last_seen), '') AS DATE), DATE '{as_of}') > 4",
        "size_tier_grace": f"""WITH f AS (SELECT doc_id, n_chars * 1024 AS size, coalesce(lang = 'zh', false) AS used, CASE WHEN posted_at IS NOT NULL AND doc_id % 2 = 0 THEN date_diff('day', posted_at::DATE, DATE '{as_of}') END AS age FROM documents)
          SELECT doc_id, CASE WHEN used THEN 'keep' WHEN age IS NULL THEN 'mark' WHEN size >= 1048576 THEN CASE WHEN age < 7 THEN 'wait' ELSE 'delete' END WHEN size >= 102400 THEN CASE WHEN age < 14 THEN 'wait' ELSE 'delete' END ELSE 'wait' END AS action FROM f""",
        "ledger_ghosts": f"SELECT key FROM {a} WHERE coalesce(fail_streak, 0) = 0 AND coalesce(date_diff('day', TRY_CAST(nullif(trim(last_seen), '') AS DATE), DATE '{as_of}'), 9999) >= 5 AND key NOT IN (SELECT key FROM sites_probe WHERE key IS NOT NULL)",
        "verdict_fold": f"""WITH r AS (SELECT key, type AS p, {_RANK.format('level')} AS k, coalesce(total > 0, false) AS e, level, generated_at AS g, probe_id AS i FROM sites_probe WHERE key IS NOT NULL AND level IS NOT NULL)
          SELECT key, level FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY p DESC NULLS LAST, e DESC, CASE WHEN e THEN g END DESC NULLS LAST, CASE WHEN e THEN i END DESC NULLS LAST, k, g DESC, i DESC) AS n FROM r WHERE k < 6 OR e OR coalesce(p, -1) >= 4) WHERE n = 1""",
        "snapshot_retraction": "WITH m AS (SELECT type, max(generated_at) AS g FROM sites_probe WHERE type IN (1, 3) GROUP BY 1) SELECT probe_id FROM sites_probe p LEFT JOIN m USING (type) WHERE m.g IS NULL OR p.generated_at = m.g",
        "backoff_reuse": f"SELECT CASE WHEN {days} > 12 THEN 'prune' WHEN health = 'healthy' THEN 'reuse' WHEN {days} < 8 THEN 'skip' ELSE 'retry' END AS action, count(*) AS n FROM interfaces WHERE key IS NOT NULL GROUP BY 1",
        "static_merge": f"""WITH x AS (SELECT key, level FROM {a} WHERE level IS NOT NULL), v AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY generated_at DESC NULLS LAST, probe_id DESC) AS n FROM sites_probe WHERE key IS NOT NULL) WHERE n = 1 AND level IS NOT NULL)
          SELECT key, level, 'existing' AS origin FROM x UNION ALL SELECT key, level, 'static' FROM v WHERE l1_ok AND key NOT IN (SELECT key FROM x)""",
        "change_log": f"SELECT a.key, CASE WHEN b.key IS NULL THEN 'new' ELSE 'changed' END AS event FROM {a} a LEFT JOIN {b} b ON a.key = b.key WHERE b.key IS NULL OR trim(a.api) IS DISTINCT FROM trim(b.api) OR trim(a.health) IS DISTINCT FROM trim(b.health) OR trim(a.level) IS DISTINCT FROM trim(b.level)",
        "min_rank_floor": "SELECT snapshot_date, count(*) AS n FROM interfaces WHERE health IN ('healthy', 'degraded') GROUP BY 1",
        "vocab_label": f"SELECT live_id, reason FROM (SELECT live_id, t, {_LABEL} AS reason FROM (SELECT live_id, lower(coalesce(name, '')) AS t FROM lives)) WHERE reason IS NOT NULL AND NOT contains(t, '少儿') AND NOT contains(t, 'kids')",
        "quarantine_split": f"SELECT group_name, CASE WHEN {_LABEL} IS NULL THEN 'clean' ELSE 'hits' END AS part, count(*) AS n FROM (SELECT group_name, lower(coalesce(name, '')) AS t FROM lives) GROUP BY 1, 2",
        "any_alive": "SELECT key, bool_or(coalesce(l1_ok, true)) AS alive FROM sites_probe WHERE key IS NOT NULL GROUP BY 1",
        "longtail_prune": "SELECT name, max(group_name) IS NOT DISTINCT FROM '其他' AND count(DISTINCT url) = 1 AND NOT bool_or(coalesce(health = 'healthy', false)) AND NOT contains(name, '音乐') AS pruned FROM lives WHERE name IS NOT NULL GROUP BY 1",
        "prune_blocks": """WITH e AS (SELECT *, event_type = 'view' AS h, coalesce(value < 60, false) AS dead, sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id) AS b FROM events),
          g AS (SELECT user_id, b FROM e GROUP BY 1, 2 HAVING bool_or(NOT h AND NOT dead)) SELECT event_id FROM e JOIN g USING (user_id, b) WHERE h OR NOT dead""",
        "dead_disposition": """WITH u AS (SELECT regexp_replace(coalesce(url, ''), '^\\s+|\\s+$', '', 'g') AS u, coalesce(channels > 20, false) AS l FROM lives WHERE health = 'dead') SELECT CASE WHEN l OR u = '' OR regexp_matches(u, '^(\\./|\\.\\./|/|file:)') OR NOT regexp_matches(u, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN 'keep'
          WHEN regexp_matches(u, '^(?i)https?://[^/]*(github|ghproxy)') THEN 'recheck' ELSE 'drop' END AS action, count(*) AS n FROM u GROUP BY 1""",
        "guard_report": """WITH t AS (SELECT health, CASE WHEN level = 'E0' THEN 0 WHEN level IS NULL THEN 403 ELSE 200 END AS c FROM interfaces) SELECT count(*) >= 100 AND count(*) FILTER (c = 0) * 10 > count(*) * 9 AND count(*) FILTER (coalesce(health <> 'dead', false)) = 0 AS network_down,
          count(*) FILTER (health = 'healthy') * 20 < count(*) AS too_few_healthy, count(*) FILTER (c NOT IN (0, 400, 403, 429)) * 2 < count(*) AS verdicts_too_few FROM t""",
        "tool_failure_guard": "SELECT source, snapshot_date, count(*) FILTER (health IN ('healthy', 'degraded')) = 0 AND count(*) FILTER (coalesce(health, 'unknown') = 'unknown') * 10 >= count(*) * 9 AS refuse FROM interfaces WHERE source IS NOT NULL GROUP BY 1, 2",
        "audited_links": """SELECT replace(fullkey, '"', '') AS json_path, count(*) AS n FROM (SELECT ext FROM sites WHERE json_valid(ext)) s, LATERAL (SELECT * FROM json_tree(s.ext)) t
          WHERE t.type = 'VARCHAR' AND regexp_matches(atom->>'$', '^https?://') AND NOT regexp_matches(replace(fullkey, '"', ''), '^\\$\\.note|\\.audit\\b') GROUP BY 1""",
        "fail_limits": "SELECT snapshot_date, count(*) AS n FROM interfaces WHERE key IS NOT NULL AND fail_streak >= CASE WHEN level = 'E0' THEN 2 WHEN level = 'S0' THEN 5 ELSE 3 END GROUP BY 1",
    }
