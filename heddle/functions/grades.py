"""Ordered grades and verdicts as column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Enums from best to worst, and what levels say about health.
HEALTH = ["healthy", "degraded", "unknown", "dead"]
LEVEL_RANK = {"L3": 0, "L2": 1, "L1": 2, "L?": 3, "L0": 4, "S1": 5, "S0": 6}
PARSE_RANK = {"ok": 0, "placeholder": 1, "no_playable": 2, "anti_chain": 2, "ad_warn": 3, "unreachable": 4}
LEVEL_HEALTH = {
    "C3": "healthy", "L3": "healthy", "L2": "degraded", "S1": "degraded", "E2": "degraded", "C0": "dead", "S0": "dead", "E0": "dead",
    "S?": "unknown", "E1": "unknown", "E?": "unknown", "P4": "degraded", "P3": "degraded", "P1": "dead", "P0": "unknown", "P2": "unknown",
}
FAIL_LIMITS = {"timeout": 5, "404": 2, "connection_refused": 2, "5xx": 3, "empty_product": 3}


def mapped(c: Column, values: dict, default: object) -> Column:
    """Looks a value up in a small fixed table; a chain of CASE branches that stays inside generated code."""
    out = F.lit(default)
    for k, v in reversed(values.items()):
        out = F.when(c == k, F.lit(v)).otherwise(out)
    return out


def health_rank(c: Column) -> Column:
    return mapped(F.coalesce(c, F.lit("unknown")), {h: i for i, h in enumerate(HEALTH)}, 2)


def level_rank(c: Column) -> Column:
    return mapped(c, LEVEL_RANK, 7)


def level_health(c: Column) -> Column:
    return mapped(c, LEVEL_HEALTH, "unknown")


def fail_limit(kind: Column) -> Column:
    return mapped(kind, FAIL_LIMITS, 3)


def funnel_grade(*gates: Column) -> Column:
    """Dn for the deepest passed gate; the top one only if all are passed."""
    n = len(gates)
    yes = [F.coalesce(g, F.lit(False)) for g in gates]
    all_of = yes[0]
    for g in yes[1:]:
        all_of = all_of & g
    out = F.lit("D0")
    for i in range(1, n):
        out = F.when(yes[i - 1], f"D{i}").otherwise(out)
    return F.when(all_of, f"D{n}").otherwise(F.when(yes[n - 1], F.when(out == "D0", "D0").otherwise(out)).otherwise(out))


#: Kinds of sites and the pattern of the group names that mean them, tried in this order.
SITE_KINDS = {"csp": "蜘蛛", "js": "本地JS", "pan": "网盘", "short": "^短剧$", "std": "采集站|直连"}


def site_kind(group: Column, kinds: dict[str, str] = SITE_KINDS) -> Column:
    """The first kind whose pattern is in the group's name; other if none is."""
    g = F.coalesce(group, F.lit(""))
    return F.coalesce(*[F.when(g.rlike(pattern), kind) for kind, pattern in kinds.items()], F.lit("other"))


def deep_verdict(code: Column) -> Column:
    """struct(level, reason) of a deep run: Gn becomes Cn; G0, C0 and stubs say nothing; a missing code is C?."""
    c = F.coalesce(code, F.lit(""))
    level = F.when(c.startswith("stub"), F.lit(None)).when(c.rlike("^G[1-9]$"), F.concat(F.lit("C"), F.substr(c, F.lit(2)))).when(c.isin("G0", "C0"), F.lit(None)).when(c == "", "C?").otherwise(c)
    reason = F.when(c.startswith("stub"), "stub").when(c == "G0", "g0").when(c == "C0", "load").otherwise("")
    return F.struct(level.cast("string").alias("level"), reason.alias("reason"))


def days_since(day: Column, as_of: str, default: int = 9999) -> Column:
    """Days from a yyyy-mm-dd text to ``as_of``; ``default`` if it is none."""
    return F.coalesce(F.datediff(F.lit(as_of).cast("date"), F.try_to_date(F.nullif(F.trim(day), F.lit("")), "yyyy-MM-dd")), F.lit(default))


def grace_days(size: Column) -> Column:
    """Days before an unreferenced file may go, by size: 7 from 1 MB, 14 from 100 KB, never below."""
    return F.when(size >= 1 << 20, 7).when(size >= 100 << 10, 14)
