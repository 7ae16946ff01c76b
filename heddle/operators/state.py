"""State machines over versions of a table: new state from old state and the incoming batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ingest_transitions(prev: DataFrame, incoming: DataFrame, *, key: str, hash: str, deleted: str) -> DataFrame:
    """(key, status): new, unchanged, changed, restored (was deleted, same content), changed_recovered, deleted or gone.

    ``deleted`` marks rows of ``prev`` that were deleted before. Nothing is ever removed.
    """
    p = prev.select(F.col(key).alias("__k"), F.col(hash).alias("__p"), F.col(deleted).alias("__d"))
    both = incoming.select(F.col(key), F.col(hash).alias("__c")).join(p, F.col(key) == F.col("__k"), "full_outer")
    same = F.col("__c").eqNullSafe(F.col("__p"))
    status = (
        F.when(F.col("__k").isNull(), "new")
        .when(F.col(key).isNull(), F.when(F.col("__d"), "gone").otherwise("deleted"))
        .when(F.col("__d"), F.when(same, "restored").otherwise("changed_recovered"))
        .otherwise(F.when(same, "unchanged").otherwise("changed"))
    )
    return both.select(F.coalesce(key, "__k").alias(key), status.alias("status"))


def needs_run(transitions: DataFrame) -> bool:
    """Whether anything happened that later stages must see."""
    return not transitions.where(F.col("status").isin("new", "changed", "changed_recovered", "restored")).isEmpty()


def stale_prune(df: DataFrame, *, key: str, seen: str, as_of: str, grace: int) -> DataFrame:
    """Keys last seen more than ``grace`` days before ``as_of``; rows with a blank date are exempt."""
    day = F.try_to_date(F.nullif(F.trim(seen), F.lit("")), "yyyy-MM-dd")
    return df.where(F.datediff(F.lit(as_of).cast("date"), day) > grace).select(key).distinct()


def stale_cascade(df: DataFrame, checks: DataFrame, *, key: str, seen: str, as_of: str, grace: int) -> tuple[DataFrame, DataFrame]:
    """What stays of a table and of its checks once stale keys are pruned with everything recorded of them."""
    gone = stale_prune(df, key=key, seen=seen, as_of=as_of, grace=grace)
    return df.join(gone, key, "left_anti"), checks.join(gone, key, "left_anti")


def index_plan(prev: DataFrame, repos: DataFrame, files: DataFrame, *, as_of: str, wait: int = 7, ttl: int = 45) -> DataFrame:
    """(repo, path, action) of an incremental index of files in repositories.

    ``prev`` has repo, pushed_at, path, sha, ok, at (the last look at a file and whether it was good); ``repos`` has repo and
    pushed_at of those asked this round, null if asking failed; ``files`` has repo, path, sha of what is there now.

    - A repository pushed since: files of the same sha are as they were, others are probed, vanished ones go.
    - An unchanged one, one where asking failed, or one not asked this round: its files are as they were, without a listing.
    - Of files as they were good ones are reused; failed ones are skipped within ``wait`` days and then probed again, but not
      where asking failed. What was not looked at for over ``ttl`` days is pruned.
    """
    p = prev.select("repo", F.col("pushed_at").alias("was"), "path", F.col("sha").alias("old"), "ok", "at")
    asked = repos.select("repo", F.col("pushed_at").alias("now"), F.lit(True).alias("asked"))
    # One row a repository and path, with what was known and what is there.
    now = files.select("repo", "path", F.col("sha").alias("new"))
    both = p.join(now, ["repo", "path"], "full_outer").join(asked, "repo", "left")
    full = both.join(p.groupBy("repo").agg(F.max("was").alias("before")), "repo", "left")
    changed = F.col("asked").isNotNull() & F.col("now").isNotNull() & ~F.col("now").eqNullSafe(F.col("before"))
    lost = F.col("asked").isNotNull() & F.col("now").isNull()
    age = F.datediff(F.lit(as_of).cast("date"), F.to_date("at"))
    kept = F.when(age > ttl, "prune").when(F.coalesce("ok", F.lit(False)), "reuse").when(lost | (age < wait), "skip").otherwise("probe")
    action = F.when(changed & F.col("new").isNull(), "gone").when(changed & ~F.col("old").eqNullSafe(F.col("new")), "probe").when(F.col("old").isNull(), F.when(changed, "probe")).otherwise(kept)
    return full.select("repo", "path", action.alias("action")).where("action is not null")


def two_phase_gc(files: DataFrame, state: DataFrame, *, path: str, referenced: str, size: str, first_seen: str, as_of: str) -> DataFrame:
    """(path, action): keep, mark (first sighting), wait, or delete when the grace of the file's size is over.

    A file that is referenced again is kept, and its old record stays.
    """
    from heddle.functions.grades import grace_days

    s = state.select(F.col(path).alias("__k"), F.col(first_seen).alias("__at"))
    full = files.join(s, F.col(path) == F.col("__k"), "left")
    age = F.datediff(F.lit(as_of).cast("date"), F.col("__at"))
    grace = grace_days(F.col(size))
    action = F.when(F.col(referenced), "keep").when(F.col("__at").isNull(), "mark").when(grace.isNull() | (age < grace), "wait").otherwise("delete")
    return full.select(path, action.alias("action"))


def ghost_rows(ledger: DataFrame, files: DataFrame, *, path: str, refs: str, updated: str, as_of: str, idle: int) -> DataFrame:
    """Ledger rows that nothing refers to, whose file is missing and that were idle for ``idle`` days; bad dates count as old."""
    from heddle.functions.grades import days_since

    lone = ledger.where((F.coalesce(refs, F.lit(0)) == 0) & (days_since(F.col(updated), as_of) >= idle))
    return lone.join(files.select(path).distinct(), path, "left_anti")


def fold_verdicts(df: DataFrame, *, key: str, priority: str, rank: str, evidence: str, level: str, at: str, trusted: int = 4) -> DataFrame:
    """(key, level): the verdict that stands after all probes of a key.

    A deeper probe (greater priority) overrides a shallower one. Within a priority the newest with evidence wins, then the
    best rank. A death without evidence counts only from a probe of at least priority ``trusted``. The order is total, so
    the fold is an aggregate with partial results: no key's rows are brought together in one task.
    """
    dead = F.col(rank) >= 6
    counts = ~dead | F.coalesce(F.col(evidence), F.lit(False)) | (F.col(priority) >= trusted)
    order = F.struct(F.col(priority).alias("p"), F.coalesce(F.col(evidence), F.lit(False)).alias("e"), F.when(F.coalesce(F.col(evidence), F.lit(False)), F.col(at)).alias("t"), (-F.col(rank)).alias("r"), F.col(at).alias("a"))
    return df.where(counts).groupBy(key).agg(F.max_by(level, order).alias("level"))


def retract_snapshot(df: DataFrame, *, probe: str, batch: str, snapshot_probes: list[str]) -> DataFrame:
    """Rows that still hold: of probes that report everything each time only the newest batch, of rotating ones all."""
    newest = df.where(F.col(probe).isin(snapshot_probes)).groupBy(F.col(probe).alias("__p")).agg(F.max(batch).alias("__b"))
    return df.join(F.broadcast(newest), F.col(probe) == F.col("__p"), "left").where(F.col("__p").isNull() | (F.col(batch) == F.col("__b"))).drop("__p", "__b")


def backoff(df: DataFrame, *, key: str, status: str, day: str, as_of: str, wait: int = 7, ttl: int = 45) -> DataFrame:
    """(key, action): reuse good entries, skip fresh failures, retry old ones, prune entries beyond the time to live."""
    age = F.datediff(F.lit(as_of).cast("date"), F.to_date(day))
    action = F.when(age > ttl, "prune").when(F.col(status) == "ok", "reuse").when(age < wait, "skip").otherwise("retry")
    return df.select(key, action.alias("action"))


def static_merge(existing: DataFrame, verdicts: DataFrame, *, key: str, level: str, evidence: str) -> DataFrame:
    """(key, level, origin): verdicts are added where none exists and only with evidence; existing ones never change."""
    add = verdicts.where(F.col(evidence)).join(existing.select(key).distinct(), key, "left_anti")
    return existing.select(key, level, F.lit("existing").alias("origin")).unionByName(add.select(key, level, F.lit("static").alias("origin")))


def change_log(prev: DataFrame, cur: DataFrame, *, key: str, hash: Column) -> DataFrame:
    """Keys whose canonical hash differs from the last one recorded, or that have none."""
    p = prev.select(F.col(key).alias("__k"), hash.alias("__h"))
    c = cur.select(F.col(key), hash.alias("h"))
    return c.join(p, F.col(key) == F.col("__k"), "left").where(~F.col("h").eqNullSafe(F.col("__h"))).select(key, F.when(F.col("__k").isNull(), "new").otherwise("changed").alias("event"))
