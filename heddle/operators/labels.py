"""Vocabulary-driven labelling, quarantine and pruning, and guards that stop a run on implausible data."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def label(df: DataFrame, vocab: DataFrame, *, id: str, text: Column, allow: DataFrame | None = None, most: int = 200_000) -> DataFrame:
    """(id, reason): the reason of the first keyword, by priority, that a text contains, unless an allowed word is in it.

    ``vocab`` has keyword, reason and priority, ``allow`` has keyword; at most ``most`` rows each, more are an error. A short
    list is folded into one expression, a long one into an automaton that scans each text once; there is no join, so nothing
    is shuffled.
    """
    words = vocab.select(F.lower("keyword").alias("keyword"), "reason", "priority").where("keyword <> ''").orderBy("priority", "keyword").limit(most + 1).collect()
    if len(words) > most:
        raise ValueError(f"more than {most} keywords; split the vocabulary")
    t = F.lower(text)
    if len(words) > 500:
        found = df.select(id, _first_keyword([(w.keyword, w.reason) for w in words])(t).alias("reason"), t.alias("__t")).where("reason is not null")
    else:
        case = F.lit(None).cast("string")
        for w in reversed(words):
            case = F.when(t.contains(w.keyword), F.lit(w.reason)).otherwise(case)
        found = df.select(id, case.alias("reason"), t.alias("__t")).where("reason is not null")
    if allow is not None:
        allowed = [a.keyword for a in allow.select(F.lower("keyword").alias("keyword")).where("keyword <> ''").distinct().limit(most + 1).collect()]
        if len(allowed) > most:
            raise ValueError(f"more than {most} allowed words; split the list")
        if len(allowed) > 500:
            found = found.where(_first_keyword([(w, "") for w in allowed])(F.col("__t")).isNull())
        else:
            for w in allowed:
                found = found.where(~F.col("__t").contains(w))
    return found.select(id, "reason")


def _first_keyword(words: list[tuple[str, str]]):
    """The reason of the first word of a list that a text contains: one automaton, one scan a text."""
    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        import ahocorasick

        auto = ahocorasick.Automaton()
        for i, (w, _) in reversed(list(enumerate(words))):
            auto.add_word(w, i)
        auto.make_automaton()
        first = lambda s: min((i for _, i in auto.iter(s)), default=None)
        return texts.map(lambda s: None if s is None or (i := first(s)) is None else words[i][1])

    return run


def quarantine(df: DataFrame, labelled: DataFrame, id: str) -> tuple[DataFrame, DataFrame]:
    """Clean rows and hits."""
    return df.join(labelled.select(id), id, "left_anti"), df.join(labelled, id)


def any_alive(df: DataFrame, *, by: str, ok: str) -> DataFrame:
    """(by, alive): an entry lives if any of its addresses does; an unknown result keeps it."""
    return df.groupBy(by).agg(F.coalesce(F.bool_or(F.coalesce(ok, F.lit(True))), F.lit(True)).alias("alive"))


def longtail(df: DataFrame, *, by: str, line: str, verified: str, cls: str, prune_class: str, exempt: Column) -> DataFrame:
    """(by, pruned): in the class to prune, entries with one line that nobody verified; exempt ones stay."""
    g = df.groupBy(by).agg(F.countDistinct(line).alias("n"), F.bool_or(F.coalesce(verified, F.lit(False))).alias("v"), F.max(cls).alias("c"), F.bool_or(exempt).alias("x"))
    return g.select(by, (F.col("c").eqNullSafe(F.lit(prune_class)) & (F.col("n") == 1) & ~F.col("v") & ~F.col("x")).alias("pruned"))


def prune_blocks(df: DataFrame, *, block: list[str], head: Column, dead: Column) -> DataFrame:
    """Drops dead lines, and whole blocks without a living line; heads go with their block."""
    alive = df.groupBy(*block).agg(F.bool_or(~head & ~dead).alias("__alive"))
    return df.where(head | ~dead).join(alive.where("__alive").drop("__alive"), block, "left_semi")


def scrub_lines(df: DataFrame, *, by: str, order: str, line: str, labelled: Column) -> DataFrame:
    """Playlist lines without those of labelled names; ``labelled`` is a condition on a column ``name``.

    A ``name,address`` line goes if its name is labelled; group headers and blank lines stay. A labelled ``#EXTINF`` goes with
    all lines after it up to the next line that begins with #.
    """
    from heddle.operators.history import carry

    text = F.trim(F.coalesce(line, F.lit("")))
    info, mark = text.startswith("#EXTINF"), text.startswith("#")
    rows = df.withColumn("name", F.when(info, F.trim(F.regexp_extract(text, r",([^,]*)$", 1))).when(~mark & text.contains(",") & ~text.rlike(r",\s*#genre#$"), F.trim(F.substring_index(text, ",", 1))).otherwise(""))
    rows = rows.withColumn("__hit", F.coalesce(labelled, F.lit(False)) & (F.col("name") != ""))
    rows = carry(rows, by=[by], order=order, state=F.when(mark, F.struct((info & F.col("__hit")).alias("drop"))), name="__s")
    inside = F.coalesce("__s.drop", F.lit(False))
    return rows.where(~(inside | (~mark & F.col("__hit")))).drop("name", "__hit", "__s")


def dispose_dead(url: Column, local_exists: Column) -> Column:
    """What to do with a dead row: keep what has a local copy or no address, check code hosts again, drop direct ones."""
    from heddle.functions.urls import url_class

    kind = url_class(url)
    return F.when(local_exists | kind.isin("no_url", "local"), "keep").when(kind == "gh", "recheck").otherwise("drop")


#: Codes that say nothing about an address.
UNVERIFIABLE = [0, 400, 403, 429]


def guards(df: DataFrame, *, code: str, ok: Column, healthy: Column, least: int = 100) -> DataFrame:
    """One row of booleans: network down (many probes, over 90 % without a code, none alive), healthy share under 5 %,
    verdict share (of codes that say something) under half."""
    n, zero = F.count(F.lit(1)), F.count_if(F.col(code) == 0)
    says = F.count_if(~F.col(code).isin(UNVERIFIABLE))
    return df.agg(
        ((n >= least) & (zero * 10 > n * 9) & (F.count_if(ok) == 0)).alias("network_down"),
        (F.count_if(healthy) * 20 < n).alias("too_few_healthy"),
        (says * 2 < n).alias("verdicts_too_few"),
    )


def tool_failure(df: DataFrame, *, by: list[str], ok: Column, message: Column, pattern: str) -> DataFrame:
    """(by, refuse): whether results must not overwrite older ones, since all failed and nine in ten messages blame the tool."""
    n = F.count(F.lit(1))
    return df.groupBy(*by).agg(((F.count_if(F.coalesce(ok, F.lit(False))) == 0) & (F.count_if(F.coalesce(message.rlike(pattern), F.lit(False))) * 10 >= n * 9)).alias("refuse"))


def may_overwrite(verdicts: DataFrame, *, local: Column, verdict: Column, floor: tuple[int, int], old_exists: bool, force: bool = False) -> bool:
    """Whether new verdicts may replace old ones: their share among rows that aren't local reaches the floor, or nothing older
    exists, or it is forced."""
    n, good = verdicts.where(~local).agg(F.count(F.lit(1)), F.count_if(verdict)).first()
    return force or not old_exists or good * floor[1] >= n * floor[0]


def exempt(path: Column, patterns: list[str]) -> Column:
    """Whether a JSON path is in a context that only quotes vocabulary, such as audit notes."""
    return F.coalesce(path.rlike("|".join(f"(?:{p})" for p in patterns)), F.lit(False)) if patterns else F.lit(False)


def require(df: DataFrame, least: int, columns: list[str], *, at: str | None = None, as_of: str | None = None, hours: int = 48) -> DataFrame:
    """``df`` itself, or an error if it is too small, lacks a column, or its newest ``at`` is over ``hours`` before ``as_of``
    or missing; run before anything is overwritten."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    if df.limit(least).count() < least:
        raise ValueError(f"fewer than {least} rows")
    if at is not None:
        late = df.agg(F.coalesce(F.max(F.col(at).cast("timestamp")) < F.lit(as_of).cast("timestamp") - F.make_dt_interval(F.lit(0), F.lit(hours)), F.lit(True))).first()[0]
        if late:
            raise ValueError(f"older than {hours} hours")
    return df
