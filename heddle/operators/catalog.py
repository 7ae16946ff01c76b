"""Smaller operators over catalogs, ledgers, rounds and pools."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heddle.functions.names import norm_key, title_norm
from heddle.functions.urls import canonical_url, harvest_links, host_of, norm_api, text
from heddle.operators.dedup import first_wins
from heddle.operators.history import upper_median
from heddle.runtime import durable

#: Hosts that are never the real target of a site.
BAD_HOST = r"^https?://(?:[^/]*github|[^/]*gitee|localhost|127\.|[^/]*example\.com)"


def static_grade(parsed: Column, has_class: Column, methods: Column, has_host: Column) -> Column:
    """P0 unparsable, P1 no class, P2 too few methods, P3 no host, P4 complete."""
    return F.when(~F.coalesce(parsed, F.lit(False)), "P0").when(~F.coalesce(has_class, F.lit(False)), "P1").when(F.coalesce(methods, F.lit(0)) < 3, "P2").when(~F.coalesce(has_host, F.lit(False)), "P3").otherwise("P4")


def target_of(api: Column, ext: Column, bad: str = BAD_HOST) -> Column:
    """struct(target, source): the first trusted address of ext, else of api; null with a reason otherwise."""
    good = lambda c: F.try_element_at(F.filter(harvest_links(c), lambda u: ~u.rlike(bad)), F.lit(1))
    e, a = good(ext), good(api)
    source = F.when(e.isNotNull(), "ext").when(a.isNotNull(), "api").when(text(api).startswith("./"), "no trusted address in rule").otherwise("no address")
    return F.struct(F.coalesce(e, a).alias("target"), source.alias("source"))


def collect_links(parts: list[tuple[DataFrame, str, Column]], *, order: str) -> DataFrame:
    """(url, categories, name) of links from several tables, each once with the sorted set of its categories and its first name.

    Each part is (table with url and name, kind, category); ``order`` is a column that ranks rows within a part, and parts
    rank in the order given. Links are made distinct with their category before they are brought together, so a link in many
    rows has as many entries as categories.
    """
    every = None
    for i, (df, kind, category) in enumerate(parts):
        rows = df.select("url", F.concat_ws(":", F.lit(kind), category).alias("category"), "name", F.struct(F.lit(i).alias("part"), F.col(order).cast("long").alias("at")).alias("o"))
        every = rows if every is None else every.unionByName(rows)
    one = every.where("url <> ''").groupBy("url", "category").agg(F.min_by("name", "o").alias("name"), F.min("o").alias("o"))
    return one.groupBy("url").agg(F.array_join(F.array_sort(F.collect_set("category")), ",").alias("categories"), F.min_by("name", "o").alias("name"))


def locate_sites(doc: Column) -> Column:
    """The site list of a JSON document as a variant array: sites, data.sites, video, or a bare array of things with an api."""
    v = F.try_parse_json(doc)
    bare = F.try_variant_get(v, "$", "array<variant>")
    listed = F.coalesce(*[F.try_variant_get(v, p, "array<variant>") for p in ("$.sites", "$.data.sites", "$.video")])
    return F.coalesce(listed, F.filter(bare, lambda x: F.try_variant_get(x, "$.api", "string").isNotNull()))


def prefer_blobs(df: DataFrame, *, group: str, path: str, size: str, deny: str = r"(^|/)(package|tsconfig|composer)(-lock)?\.json$", ext: str = r"\.(json|txt|js|m3u)$", k: int = 8) -> DataFrame:
    """At most ``k`` blobs of each group of a fitting suffix and size (500 bytes to 12 MB), the largest first. The limit is
    the feature; a group limit runs before the shuffle."""
    ok = df.where(F.lower(path).rlike(ext) & ~F.lower(path).rlike(deny) & F.col(size).between(500, 12 << 20))
    return ok.withColumn("n", F.row_number().over(Window.partitionBy(group).orderBy(F.desc(size), path))).where(F.col("n") <= k)


def prefix_hosts(c: Column) -> Column:
    """Hosts that stand in front of another full address."""
    return F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(r"https?://([^/\s]+)/https?://"), F.lit(1))


def alternates(df: DataFrame, prefixes: DataFrame, *, url: str, prefix: str, failure: str, environment: list[str], most: int = 3) -> DataFrame:
    """(url, candidate): other prefixes to try, only for failures of the environment, never the current one, at most ``most``.

    The prefix list is collected and must stay short; it becomes an array, so there is no cross join.
    """
    known = [r[0] for r in prefixes.select(prefix).distinct().orderBy(prefix).limit(101).collect()]
    if len(known) > 100:
        raise ValueError("more than 100 prefixes")
    others = F.slice(F.filter(F.array(*[F.lit(p) for p in known]) if known else F.array().cast("array<string>"), lambda p: ~F.col(url).startswith(p)), 1, most)
    bare = F.regexp_replace(F.col(url), r"^https?://[^/]+/(?=https?://)", "")
    return df.where(F.col(failure).isin(environment)).select(url, F.explode(F.transform(others, lambda p: F.concat(p, bare))).alias("candidate"))


def inline_segments(c: Column, contents: Column, low: int, high: int) -> Column:
    """struct(text, notes): parts between $$$ replaced by their content from a map if its size is within the window."""
    parts = F.split(F.coalesce(c, F.lit("")), r"\$\$\$")
    size = lambda p: F.length(F.try_element_at(contents, p))
    fit = lambda p: size(p).between(low, high)
    made = F.transform(parts, lambda p: F.when(fit(p), F.try_element_at(contents, p)).otherwise(p))
    notes = F.transform(parts, lambda p: F.when(fit(p), "inlined").when(size(p).isNull(), "kept").when(size(p) < low, "small").otherwise("large"))
    return F.struct(F.array_join(made, "$$$").alias("text"), F.array_join(notes, ",").alias("notes"))


def rewrite_segments(c: Column, local: Column, failed: Column) -> Column:
    """References between $$$ replaced by their local names; failed ones are dropped; null if nothing is left."""
    parts = F.filter(F.split(F.coalesce(c, F.lit("")), r"\$\$\$"), lambda p: (p != "") & ~F.array_contains(failed, p))
    return F.nullif(F.array_join(F.transform(parts, lambda p: F.coalesce(F.try_element_at(local, p), p)), "$$$"), F.lit(""))


def rewrite_documents(df: DataFrame, *, id: str, column: str, local: dict[str, str], failed: set[str]) -> DataFrame:
    """(id, text, removed): JSON documents with references replaced by their local names at any depth.

    In a value with $$$ each part is replaced by what stands before its first ;, keeping the rest; failed parts are dropped.
    An element of a list named ``sites`` that refers to something failed is removed whole, and ``removed`` counts those.
    Texts that are no JSON come back as they are, nulls as null. ``local`` and ``failed`` go to the workers with the task.
    """
    import json

    bare = lambda part: part.split(";")[0].strip()

    def value(text: str) -> str:
        if text.strip() in local:
            return local[text.strip()]
        if "$$$" not in text:
            return text
        return "$$$".join(local[bare(p)] + p[len(bare(p)) :] if bare(p) in local else p for p in text.split("$$$") if bare(p) in local or bare(p) not in failed)

    def broken(site: object) -> bool:
        texts = [x for x in site.values() if isinstance(x, str)] if isinstance(site, dict) else []
        return any(x.strip() in failed or ("$$$" in x and any(bare(p) in failed for p in x.split("$$$"))) for x in texts)

    def walk(doc: object) -> tuple[object, int]:
        """Rewrites a document level by level from a stack of places, so depth is no limit."""
        top, gone = [doc], 0
        todo: list[tuple[object, object, bool]] = [(top, 0, False)]
        while todo:
            holder, place, sites = todo.pop()
            x = holder[place]
            if isinstance(x, str):
                holder[place] = value(x)
            elif isinstance(x, dict):
                holder[place] = made = dict(x)
                todo += [(made, k, k == "sites") for k in made]
            elif isinstance(x, list):
                holder[place] = made = [y for y in x if not (sites and broken(y))]
                gone += len(x) - len(made)
                todo += [(made, i, sites) for i in range(len(made))]
        return top[0], gone

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, removed = [], []
            for t in b.column("t").to_pylist():
                try:
                    doc, gone = walk(json.loads(t)) if t is not None else (None, 0)
                except (ValueError, RecursionError):
                    doc, gone = None, 0
                else:
                    t = json.dumps(doc, ensure_ascii=False) if t is not None else None
                texts.append(t)
                removed.append(gone)
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(texts, pa.string()), pa.array(removed, pa.int32())], names=["id", "text", "removed"])

    kind = dict(df.dtypes)[id]
    return df.select(F.col(id).alias("id"), F.col(column).alias("t")).mapInArrow(run, f"id {kind}, text string, removed int")


def segment_label(c: Column, words: str) -> Column:
    """Whether any part of a name between slashes is exactly one of the words (a regular expression)."""
    return F.exists(F.split(F.coalesce(c, F.lit("")), "/"), lambda s: F.trim(s).rlike(f"^(?:{words})$"))


def archive_verdict(entry: Column, value: Column, words: str, guard: str) -> Column:
    """What an archive entry's text is: vocabulary files are skipped, guarded words are no hits, names count only for binaries."""
    binary = entry.rlike(r"\.(jar|png|jpg|zip)$")
    subject = F.when(binary, entry).otherwise(value)
    return F.when(entry.rlike(r"(^|/)vocab"), "skipped").when(~subject.rlike(words), "clean").when(subject.rlike(guard), "guarded").otherwise("word")


def trusted_rows(df: DataFrame, *, level: str, evidence: Column, death: str = "C0") -> DataFrame:
    """Without deaths that lack recognised evidence; other levels stay."""
    return df.where(~((F.col(level) == death) & ~F.coalesce(evidence, F.lit(False))) | F.col(level).isNull())


def retention(names: DataFrame, keep: DataFrame, *, name: str, day: Column, as_of: str, days: int) -> DataFrame:
    """(name, action): keep what is listed, what has no date in its name, and what is younger than ``days``."""
    marked = names.select(name, day.alias("__d")).join(keep.select(name).distinct().withColumn("__keep", F.lit(True)), name, "left")
    old = F.datediff(F.lit(as_of).cast("date"), F.col("__d")) > days
    return marked.select(name, F.when(F.col("__keep") | F.col("__d").isNull() | ~old, "keep").otherwise("delete").alias("action"))


def link_streams(streams: DataFrame, channels: DataFrame, *, channel: str, id: str) -> DataFrame:
    """Streams with ``orphan`` true where their channel is unknown or null."""
    known = channels.select(F.col(id).alias("__id")).where("__id is not null").distinct()
    return streams.join(known, F.col(channel) == F.col("__id"), "left").withColumn("orphan", F.col("__id").isNull()).drop("__id")


def alias_merge(existing: DataFrame, new: DataFrame, *, alias: str, target: str) -> DataFrame:
    """Aliases with their targets: existing ones win; of new ones for an alias the least target."""
    add = new.where(F.col(alias).isNotNull()).groupBy(alias).agg(F.min(target).alias(target))
    return existing.select(alias, target).unionByName(add.join(existing.select(alias), alias, "left_anti"))


def fresh_rounds(df: DataFrame, *, at: str, as_of: str, days: int = 3) -> DataFrame:
    """Rounds not older than ``days`` at ``as_of``; rounds without a readable time are as old as can be."""
    when = F.try_to_timestamp(F.col(at).cast("string"))
    return df.where(when >= F.lit(as_of).cast("timestamp") - F.make_dt_interval(F.lit(days)))


def round_winner(df: DataFrame, *, item: str, round: str, value: str, least: int = 2) -> DataFrame:
    """(item, rounds, median): items in at least ``least`` rounds with their upper median, best first.

    Rounds and values are counted, not collected, so an item may have any number of them.
    """
    rounds = df.groupBy(item).agg(F.count_distinct(round).alias("rounds")).where(F.col("rounds") >= least)
    return rounds.join(upper_median(df, item, value), item).select(item, "rounds", "median").orderBy(F.desc("median"), item)


def protect(candidates: DataFrame, live: DataFrame, *, path: str) -> DataFrame:
    """Candidates that no live path equals, whatever its case, and that are in no folder a live path names."""
    c = candidates.select(path, F.lower(path).alias("__f")).withColumn("__parts", F.split("__f", "/"))
    ups = F.transform(F.sequence(F.lit(1), F.size("__parts")), lambda i: F.array_join(F.slice("__parts", 1, i), "/"))
    names = live.select(F.lower(F.regexp_replace(path, "/+$", "")).alias("__l")).distinct()
    hit = c.select(path, F.explode(ups).alias("__l")).join(names, "__l", "left_semi").select(path).distinct()
    return c.select(path).join(hit, path, "left_anti")


def two_phase_duplicates(df: DataFrame, *, path: str, size: str, content: str) -> DataFrame:
    """(hash, first, copies): equal contents, hashing only files whose size occurs more than once."""
    often = df.groupBy(size).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").select(size)
    return df.join(often, size, "left_semi").groupBy(F.md5(F.col(content)).alias("hash")).agg(F.min(path).alias("first"), F.count(F.lit(1)).alias("copies")).where("copies > 1")


def rotation_decide(df: DataFrame, *, name: str) -> DataFrame:
    """(name, action): the greatest name stays, others are untracked."""
    top = df.agg(F.max(name)).first()[0]
    return df.select(name, F.when(F.col(name) == F.lit(top), "keep").otherwise("untrack").alias("action"))


def artefact_age(at: Column, now: str) -> Column:
    """Hours since an artefact was made; 999 for a missing or unreadable time."""
    seconds = F.unix_timestamp(F.lit(now).cast("timestamp")) - F.unix_timestamp(F.try_to_timestamp(at))
    return F.coalesce(seconds / 3600, F.lit(999.0))


def prune_text(df: DataFrame, *, by: str, order: str, line: str, dead: Column, alive: Column) -> DataFrame:
    """(by, order, line, place) of TXT playlists: dead lines go, then headers without lines; within a header living lines
    come first, each kind in its old order."""
    from heddle.operators.history import block_ids

    head = F.col(line).rlike(r",\s*#genre#\s*$")
    rows = block_ids(df.withColumn("__h", head), by=[by], order=order, starts=F.col("__h"))
    kept = rows.where(F.col("__h") | ~F.coalesce(dead, F.lit(False)))
    full = kept.groupBy(by, "block").agg(F.bool_or(~F.col("__h")).alias("__any")).where("__any").drop("__any")
    kept = kept.join(full, [by, "block"], "left_semi")
    rank = F.when(F.col("__h"), 0).when(F.coalesce(alive, F.lit(False)), 1).otherwise(2)
    return kept.withColumn("place", F.row_number().over(Window.partitionBy(by, "block").orderBy(rank, order)) - 1).select(by, "block", order, line, "place")


def alert_once(current: DataFrame, sent: DataFrame, *, metric: str, value: str, limit: str) -> DataFrame:
    """(metric, alert): over its limit and not reported yet."""
    s = sent.select(metric).distinct().withColumn("__sent", F.lit(True))
    over = F.col(value) > F.col(limit)
    return current.join(s, metric, "left").select(metric, F.coalesce(over & F.col("__sent").isNull(), F.lit(False)).alias("alert"))


def layered_dedup(sites: DataFrame, sources: DataFrame, lives: DataFrame | None = None, *, order: str) -> DataFrame:
    """(layer, rows) after each layer: raw, decay filter on the source, key and api, fingerprint (type, api, jar), and,
    if given, the live entries by normalised name and address.

    ``sources`` has name and decayed; ``lives`` has name, url, src and live_id. Each layer is written once and read by the
    next, so no layer is worked out twice.
    """
    gone = sources.where("decayed").select(F.col("name").alias("src"))
    live = sites.join(gone, "src", "left_anti")
    l1 = durable(first_wins(live.withColumn("__nk", norm_key(F.col("key"))).where("__nk <> ''"), [F.col("__nk"), norm_api(F.col("api"))], [order]))
    l2 = first_wins(l1, [F.col("type"), norm_api(F.col("api")), F.coalesce("jar", F.lit(""))], [order])
    layers = [("raw", sites), ("decay", live), ("key", l1), ("fingerprint", l2)]
    if lives is not None:
        there = lives.join(gone, "src", "left_anti").where(F.trim(F.coalesce("url", F.lit(""))) != "")
        layers.append(("lives", first_wins(there, [title_norm(F.col("name")), F.trim("url")], ["live_id"])))
    out = None
    for i, (name, df) in enumerate(layers):
        one = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(i).alias("layer"), F.lit(name).alias("layer_name"), "n")
        out = one if out is None else out.unionByName(one)
    return out


def annotate(sites: DataFrame, *, key: str, api: str, name: str) -> DataFrame:
    """Canonical key, address and name beside the originals, and whether any differs."""
    from heddle.functions.names import normalize_name

    k, u, n = norm_key(F.col(key)), canonical_url(F.col(api)), normalize_name(F.col(name))
    return sites.withColumn("c_key", k).withColumn("c_url", u).withColumn("c_name", n).withColumn("c_host", host_of(F.col(api))).withColumn("changed", (F.col("c_key") != F.coalesce(key, F.lit(""))) | (F.col("c_name") != F.coalesce(name, F.lit(""))))
