import datetime as dt
import random

import numpy as np
import pytest

from heddle.llm.fusion import FusionConfig, SourceModel, decide_newest, fuse, golden_records, posteriors, survivors

SCHEMA = "e string, s string, v string, t timestamp, value string, posterior double"


def run(spark, rows, newest=False, config=None):
    df = spark.createDataFrame([(*r, "x", 0.0) for r in rows], SCHEMA)
    out = fuse(df, entity="e", source="s", value="v", at="t" if newest else None, config=config).collect()
    return {r.entity: r.value for r in out}


def day(n):
    return dt.datetime(2026, 1, n)


def test_posteriors():
    m = SourceModel(["a", "b", "c"], np.array([0.8, 0.8, 0.8]), np.zeros((3, 3)))
    p = posteriors([0, 0, 1], [0, 1, 2], m, FusionConfig())
    assert p[0] > 0.9 > p[1] and p.sum() < 1
    copied = SourceModel(["a", "b", "c"], np.array([0.8, 0.8, 0.8]), np.array([[0, 1, 0], [1, 0, 0], [0, 0, 0]], dtype=float))
    q = posteriors([0, 0, 1], [0, 1, 2], copied, FusionConfig())
    assert p[0] > q[0] > q[1]


def test_edges(spark):
    assert run(spark, []) == {}
    rows = [(None, "s", "v", day(1)), ("e", None, "v", day(1)), ("e", "s", None, day(1)), ("f", "s", "", day(1)), ("f", "s", "", day(1)), ("g", "s", "x" * 9000, None)]
    assert run(spark, rows) == {"f": "", "g": "x" * 9000}
    assert run(spark, rows, newest=True) == {"f": ""}


def test_newest_claims_only(spark):
    rows = [("e", s, "old", day(1)) for s in "abc"] + [("e", "d", "new", day(2))]
    assert run(spark, rows) == {"e": "old"} and run(spark, rows, newest=True) == {"e": "new"}


def test_a_source_counts_once_and_ties_are_fixed(spark):
    rows = [("e", "a", "x", day(1))] * 5 + [("e", "b", "y", day(1)), ("e", "c", "y", day(1))]
    assert run(spark, rows) == {"e": "y"}
    assert run(spark, [("e", "a", "x", day(1)), ("e", "b", "y", day(1))]) == {"e": "y"}


@pytest.mark.parametrize("newest", [False, True])
def test_any_number_of_sources(spark, newest):
    """With more sources than arrays are meant for, tables give the same."""
    r = random.Random(3)
    rows = [(f"e{i}", f"s{j:02}", f"v{r.choice([0, 0, 0, 1, 2])}", day(r.choice([1, 2]))) for i in range(60) for j in range(12) if r.random() < 0.6]
    df = spark.createDataFrame(rows, "e string, s string, v string, t timestamp")
    got = [sorted((x.entity, x.value, round(x.posterior, 9)) for x in fuse(df, entity="e", source="s", value="v", at="t" if newest else None, config=FusionConfig(most_sources=m)).collect()) for m in (1000, 3)]
    assert got[0] == got[1] and len(got[0]) == 60


def test_newest_values_and_conflicts_among_them(spark):
    """One newest value stands whatever the sources are worth; of several the better source's does."""
    rows = [("only", "bad", "new", day(3))] + [("only", s, "old", day(1)) for s in ("good", "fine", "sound")]
    for i in range(40):
        rows += [(f"e{i}", s, f"t{i}", day(1)) for s in ("good", "fine", "sound")] + [(f"e{i}", "bad", f"x{i}", day(1))]
    rows += [("both", "good", "a", day(2)), ("both", "bad", "z", day(2)), (None, "s", "v", day(1)), ("n", "s", None, day(1)), ("n", None, "v", day(1)), ("n", "s", "v", None)]
    df = spark.createDataFrame([(*r, "x", 0.0) for r in rows], SCHEMA)
    got = {x.entity: x.value for x in decide_newest(df, entity="e", source="s", value="v", at="t").collect()}
    assert got["only"] == "new" and got["both"] == "a" and len(got) == 42 and None not in got
    assert {x.entity: x.value for x in decide_newest(df.where("e = 'only'"), entity="e", source="s", value="v", at="t").collect()} == {"only": "new"}
    assert decide_newest(df.limit(0), entity="e", source="s", value="v", at="t").count() == 0


def test_newest_values_come_through_the_method_without_conflicts_too(spark):
    """No entity has two newest values, yet each has its posterior from estimated sources, in which copies add less."""
    rows = [("copied", s, "v", day(2)) for s in ("bad", "copy")] + [("apart", s, "v", day(2)) for s in ("good", "fine")]
    for i in range(100):
        rows += [(f"e{i}", s, f"t{i}", day(1)) for s in ("good", "fine", "sound")]
        rows += [(f"e{i}", s, *((f"t{i}", day(1)) if i % 3 else (f"x{i}", day(2)))) for s in ("bad", "copy")]
    df = spark.createDataFrame(rows, "e string, s string, v string, t timestamp")
    names = {"entity": "e", "source": "s", "value": "v", "at": "t"}
    got, same = ({x.entity: (x.value, round(x.posterior, 9)) for x in made.collect()} for made in (decide_newest(df, **names), fuse(df, **names)))
    assert got == same and len(got) == 102
    assert got["e0"][0] == "x0" and got["e1"][0] == "t1" and got["e0"][1] < got["e1"][1]
    assert got["copied"][0] == got["apart"][0] == "v" and got["copied"][1] < got["apart"][1] - 0.01


def test_golden_records(spark):
    rows = [(1, s, "Name", 5, None) for s in "abc"] + [(1, "d", "Nme", 5, "j"), (2, "a", None, None, None), (None, "a", "x", 1, "y"), (3, None, "x", 1, "y")]
    got = sorted((r.entity, r.field, r.value) for r in golden_records(spark.createDataFrame(rows, "id long, src string, name string, n int, jar string"), entity="id", source="src", fields=["name", "n", "jar"]).collect())
    assert got == [(1, "jar", "j"), (1, "n", "5"), (1, "name", "Name")]


def test_copied_errors_lose(spark):
    """A bad source and its two copies tie with three good ones in a plain vote, not here."""
    r = random.Random(1)
    rows, truth = [], {}
    for i in range(300):
        e, true = f"e{i}", f"t{i}"
        truth[e] = true
        bad = true if r.random() < 0.5 else f"f{r.randrange(5)}"
        for s in ("bad", "copy1", "copy2"):
            rows.append((e, s, bad if s == "bad" or r.random() < 0.95 else f"g{r.randrange(5)}", day(1)))
        for s in ("good1", "good2", "good3"):
            rows.append((e, s, true if r.random() < 0.85 else f"h{s}{r.randrange(9)}", day(1)))
    got = run(spark, rows, config=FusionConfig(rounds=5))
    fused = sum(got[e] == truth[e] for e in truth)
    votes = 0
    for e in truth:
        c = {}
        for x, _, v, _ in rows:
            if x == e:
                c[v] = c.get(v, 0) + 1
        votes += max(c, key=lambda v: (c[v], v)) == truth[e]
    assert fused > votes + 30


def test_survivors(spark):
    groups = spark.createDataFrame([("a", "a"), ("b", "a"), ("c", "a"), ("y", "y"), ("z", "y")], "key string, group_key string")
    level = spark.createDataFrame([("a", "L1"), ("b", "L3"), ("c", "L3"), ("z", "??")], "entity string, value string")
    ms = spark.createDataFrame([("b", "20"), ("c", "9")], "entity string, value string")
    named = spark.createDataFrame([("a", day(2)), ("c", day(1))], "key string, at timestamp")
    got = sorted(map(tuple, survivors(groups, level, ms, named, ["L3", "L1"]).collect()))
    assert got == [("a", "c", "a"), ("y", "y", "y")]
