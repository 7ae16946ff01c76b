import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from heddle.functions.names import norm_key
from heddle.operators import dedup, history, joins, labels, mirrors, state
from heddle.runtime import broadcast_if_small, hot_lookup


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_first_wins_does_not_depend_on_partitions(spark):
    data = [(i, "k" if i % 3 else None, f"v{i}") for i in range(90)]
    for n in (1, 7):
        df = spark.createDataFrame(data, "i int, k string, v string").repartition(n)
        assert rows(dedup.first_wins(df, [F.col("k")], ["i"])) == [(0, None, "v0"), (1, "k", "v1")]
    assert dedup.first_wins(spark.createDataFrame([], "i int, k string"), [F.col("k")], ["i"]).count() == 0


def test_rename_keys(spark):
    df = spark.createDataFrame([(1, "A-b", "x"), (2, "ab", "X"), (3, "a b", "y"), (4, "ab", "z"), (5, "", "q"), (6, "ab2", "w")], "i int, key string, api string")
    got = {r.i: r.new_key for r in dedup.rename_keys(df, key="key", api="api", order=["i"]).collect()}
    assert got == {1: "A-b", 3: "ab-2", 4: "ab-3", 6: "ab2"}


def test_name_best(spark):
    data = [(1, "n", "k", "u/1-aa", 1, 0, ""), (2, "n", "k", "u/aa", 0, 0, ""), (3, "n", "k", "u/bb", 0, 0, ""), (4, "m", "k", "u/aa", 0, 0, ""), (5, None, "k", "u/aa", 0, 0, "x")]
    df = spark.createDataFrame(data, "i int, name string, key string, origin string, s int, q int, api string")
    out = dedup.name_best(df, name="name", key="key", origin="origin", searchable="s", quick="q", api="api", order=["i"])
    assert {r.i: r.shown_name for r in out.collect()} == {1: "n", 3: "n[bb]", 4: "m", 5: None}


def test_collisions_and_contents(spark):
    df = spark.createDataFrame([(1, "a_b"), (2, "A-B"), (3, "a_b/"), (4, "c"), (5, None)], "i int, k string")
    assert rows(dedup.collisions(df, norm_key(F.col("k")), F.col("k"))) == [("ab", 2, 2)] or rows(dedup.collisions(df, norm_key(F.col("k")), F.col("k")))[0][0] == "ab"
    docs = spark.createDataFrame([(1, "x", 5, True), (2, "x", 7, True), (3, "x", 9, False), (4, "y", 1, True)], "i int, t string, n long, whole boolean")
    assert [tuple(r)[1:] for r in dedup.content_groups(docs, content=F.col("t"), size=F.col("n"), order="i", whole=F.col("whole")).collect()] == [(2, 7)]


def test_case_collisions_are_idempotent(spark):
    df = spark.createDataFrame([("a/X.json",), ("a/x.json",), ("a/y",), (None,)], "path string")
    got = dedup.case_collisions(df, path="path")
    (r,) = got.collect()
    assert r.path == "a/x.json" and r.new_path.startswith("a/x~") and r.new_path.endswith(".json")
    again = spark.createDataFrame([("a/X.json",), (r.new_path,), ("a/y",)], "path string")
    assert dedup.case_collisions(again, path="path").count() == 0


def test_diffs(spark):
    a = spark.createDataFrame([("k1", "n", "x"), ("k2", "n", None), ("k4", "n", "z")], "key string, name string, api string")
    b = spark.createDataFrame([("k1", "m", "x"), ("k2", "n", None), ("k3", "n", "")], "key string, name string, api string")
    assert rows(joins.field_diff(a, b, key="key", fields=["name", "api"])) == [("k1", "modified", "name"), ("k3", "added", ""), ("k4", "removed", "")]
    p = spark.createDataFrame([("k1", "A", "healthy"), ("k2", "B", "dead"), ("k3", "", "healthy"), ("k5", "E", "healthy")], "key string, f string, h string")
    c = spark.createDataFrame([("k9", "A", "dead"), ("k2", "B", "healthy"), ("k3", "", None), ("k4", "D", "dead")], "key string, f string, h string")
    assert rows(joins.health_diff(p, c, key="key", fingerprint=F.col("f"), health="h")) == [("k2", "recovered"), ("k4", "new"), ("k5", "gone"), ("k9", "down")]


def test_merges(spark):
    cur = spark.createDataFrame([("a", 1, None), ("b", None, "x")], "k string, n int, s string")
    prev = spark.createDataFrame([("a", 9, "p"), ("c", 3, "q")], "k string, n int, s string")
    assert rows(joins.carry_forward(cur, prev, "k", ["n", "s"])) == [("a", 1, "p"), ("b", None, "x"), ("c", 3, "q")]
    assert rows(joins.supplement(cur, prev, "k")) == [("a", 1, None), ("b", None, "x"), ("c", 3, "q")]
    pool = spark.createDataFrame([("a", 1), ("b", 0), ("c", 5)], "k string, h int")
    fresh = spark.createDataFrame([("a",), ("x",), ("y",), ("z",)], "k string")
    assert rows(joins.pool_merge(pool, fresh, key="k", history="h", order=["k"], most_new=2)) == [("a", "kept"), ("c", "vanished"), ("x", "new"), ("y", "new")]
    e = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3"), ("e", "5")], "k string, h string")
    f = spark.createDataFrame([("a", "1"), ("b", "9"), ("d", "4"), ("e", None)], "k string, h string")
    assert rows(joins.reconcile(e, f, key="k", hash="h")) == [("a", "ok"), ("b", "mismatch"), ("c", "missing"), ("d", "extra"), ("e", "unread")]
    r1, r2 = spark.createDataFrame([("a", 3), ("b", 1)], "k string, r int"), spark.createDataFrame([("a", 2), ("b", 5), ("c", 4)], "k string, r int")
    assert rows(joins.improve_only(r1, r2, key="k", rank="r")) == [("a", 2), ("b", 1), ("c", 4)]


def test_lookups(spark):
    df = spark.createDataFrame([(1, "n1", "u1"), (2, "zz", "u2"), (3, "zz", None)], "i int, name string, url string")
    ref = spark.createDataFrame([("n1", "u9", "A", 2), ("n1", "u8", "B", 1), ("n2", "u2", "C", 3)], "name string, ckey string, v string, o int")
    got = joins.first_match(df, ref, [(F.col("name"), "name"), (F.col("url"), "ckey")], "v", "o", "v")
    assert {r.i: r.v for r in got.collect()} == {1: "B", 2: "C", 3: None}
    p = spark.createDataFrame([("abcdef",), ("abx",), ("zzz",)], "l string")
    r = spark.createDataFrame([("abc",), ("abcdefgh",), ("a",)], "r string")
    assert {x.l: x.m for x in joins.prefix_match(p, r, left="l", right="r", length=3, name="m").collect()} == {"abcdef": "abc", "abx": None, "zzz": None}
    jobs = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    lines = spark.createDataFrame([('{"k": 1}',), ("garbage {",), (None,), ('{"q": 2}',)], "t string")
    assert rows(joins.unfinished(jobs, lines, key="k", line="t", field="k")) == [(2,), (3,)]
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("x", "x")], "s string, t string")
    assert rows(joins.follow(e, src="s", dst="t")) == [("a", "b", 1), ("a", "c", 2), ("b", "a", 2), ("b", "c", 1), ("c", "a", 1), ("c", "b", 2)]


def test_hot_lookup_splits_hot_keys(spark):
    big = spark.createDataFrame([("h", i) for i in range(50)] + [("a", 1), (None, 2), ("q", 3)], "k string, i int")
    small = spark.createDataFrame([("h", "H", 50), ("a", "A", 1), (None, "N", 1)], "k string, v string, n int")
    for at_least in (10, 1000):
        got = hot_lookup(big, small, ["k"], "n", at_least=at_least)
        assert got.count() == 53 and {r.k: r.v for r in got.collect()} == {"h": "H", "a": "A", None: "N", "q": None}


def test_broadcast_only_what_is_small(spark):
    df = spark.createDataFrame([("x" * 50,)] * 20, "v string")
    hinted = lambda d: "broadcast" in d._jdf.queryExecution().analyzed().toString().lower()
    assert hinted(broadcast_if_small(df)) and not hinted(broadcast_if_small(df, max_rows=10)) and not hinted(broadcast_if_small(df, max_bytes=100))


def test_histories(spark):
    day = lambda n: f"2026-01-{n:02}"
    data = [("a", day(1), True), ("a", day(2), False), ("a", day(4), False), ("b", day(1), False), ("b", day(2), True), ("c", day(1), False)] + [("d", day(i), False) for i in range(1, 8)]
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(data)], "k string, day string, ok boolean, o int")
    got = history.fail_streak(df, by="k", day="day", failed=~F.col("ok"), order="o", as_of=day(9))
    assert rows(got) == [("a", 2), ("b", 0), ("c", 1), ("d", 7)]
    assert rows(history.decay_stage(df, by="k", day="day", ok=F.col("ok"))) == [("a", 2, "active"), ("b", 0, "active"), ("c", 1, "active"), ("d", 7, "out")]
    g = spark.createDataFrame([("a", i, True) for i in range(7)] + [("b", i, True) for i in range(6)] + [("b", 9, None)] + [("c", i, i != 3) for i in range(7)], "k string, o int, s boolean")
    assert rows(history.gate(g, by="k", success="s", order=[F.desc("o")])) == [("a", True, ""), ("b", False, "days"), ("c", False, "failures")]
    assert rows(history.gate(g, by="k", success="s", order=[F.desc("o")], max_failures=1, label=F.col("k") == "a")) == [("a", False, "label"), ("b", False, "days"), ("c", True, "")]


@pytest.mark.parametrize("n", [1, 5])
def test_carry_and_blocks_over_pieces(spark, n):
    r = random.Random(1)
    data = [(k, o, r.choice([None, None, f"s{o}"])) for k in ("hot", "b") for o in range(300 if k == "hot" else 5)]
    df = spark.createDataFrame(data, "k string, o long, s string").repartition(n)
    want, last, blocks, count = {}, {}, {}, {}
    for k, o, s in data:
        last[k] = s if s is not None else last.get(k)
        count[k] = count.get(k, 0) + (s is not None)
        want[(k, o)], blocks[(k, o)] = last[k], count[k]
    for piece in (16, 10_000):
        got = history.carry(df, by=["k"], order="o", state=F.col("s"), name="c", piece=piece)
        assert {(x.k, x.o): x.c for x in got.collect()} == want
        got = history.block_ids(df, by=["k"], order="o", starts=F.col("s").isNotNull(), piece=piece)
        assert {(x.k, x.o): x.block for x in got.collect()} == blocks


def test_medians_ranks_and_windows(spark):
    df = spark.createDataFrame([("a", v) for v in (5, 1, 3, 3)] + [("b", 2), ("b", None), (None, 7)], "k string, v int")
    assert {r.k: r["median"] for r in history.upper_median(df, "k", "v").collect()} == {"a": 3, "b": 2, None: 7}
    many = spark.createDataFrame([(f"k{i:03}",) for i in range(100)], "k string").repartition(6)
    assert [r.rank for r in history.global_rank(many, ["k"]).orderBy("k").collect()] == list(range(100))
    seen = set()
    for i in range(40):
        w = {r.k for r in history.rotation_window(many, key="k", day=f"2026-{i}", width=25).collect()} if i < 6 else set()
        assert i >= 6 or len(w) == 25
        seen |= w
    assert len(seen) > 50
    assert rows(history.hash_sample(many, "k", "s", 5)) == rows(history.hash_sample(many.repartition(2), "k", "s", 5))


def test_state_machines(spark):
    prev = spark.createDataFrame([("a", "1", False), ("b", "1", False), ("c", "1", True), ("d", "1", True), ("e", "1", False), ("f", "1", True)], "k string, h string, gone boolean")
    new = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "1"), ("d", "2"), ("x", "1")], "k string, h string")
    t = state.ingest_transitions(prev, new, key="k", hash="h", deleted="gone")
    assert rows(t) == [("a", "unchanged"), ("b", "changed"), ("c", "restored"), ("d", "changed_recovered"), ("e", "deleted"), ("f", "gone"), ("x", "new")]
    assert state.needs_run(t) and not state.needs_run(t.where("status in ('unchanged', 'deleted')"))
    s = spark.createDataFrame([("a", "2026-01-01"), ("b", ""), ("c", None), ("d", "2026-01-09")], "k string, seen string")
    assert rows(state.stale_prune(s, key="k", seen="seen", as_of="2026-01-10", grace=7)) == [("a",)]
    files = spark.createDataFrame([("a", True, 5 << 20), ("b", False, 5 << 20), ("c", False, 5 << 20), ("d", False, 1), ("e", False, 5 << 20)], "p string, used boolean, n long")
    seen = spark.createDataFrame([("b", dt.date(2026, 1, 1)), ("d", dt.date(2020, 1, 1)), ("e", dt.date(2026, 1, 9))], "p string, at date")
    got = state.two_phase_gc(files, seen, path="p", referenced="used", size="n", first_seen="at", as_of="2026-01-10")
    assert rows(got) == [("a", "keep"), ("b", "delete"), ("c", "mark"), ("d", "wait"), ("e", "wait")]


def test_verdicts(spark):
    schema = "k string, priority int, rank int, evidence boolean, level string, at int"
    data = [
        ("deeper", 2, 0, True, "L3", 9), ("deeper", 4, 6, False, "S0", 1),
        ("nodeath", 2, 6, False, "S0", 5), ("nodeath", 1, 2, False, "L2", 1),
        ("better", 3, 4, False, "L0", 1), ("better", 3, 0, False, "L3", 2), ("better", 3, 5, False, "S1", 9),
        ("evidence", 3, 0, False, "L3", 1), ("evidence", 3, 6, True, "S0", 2),
    ]
    want = [("better", "L3"), ("deeper", "S0"), ("evidence", "S0"), ("nodeath", "L2")]
    for order in (data, data[::-1]):
        df = spark.createDataFrame(order, schema).repartition(3)
        assert rows(state.fold_verdicts(df, key="k", priority="priority", rank="rank", evidence="evidence", level="level", at="at")) == want
    p = spark.createDataFrame([("a", "snap", 1), ("a", "snap", 2), ("b", "snap", 1), ("b", "rot", 1)], "k string, p string, b int")
    assert rows(state.retract_snapshot(p, probe="p", batch="b", snapshot_probes=["snap"]).select("k", "p", "b")) == [("a", "snap", 2), ("b", "rot", 1)]
    ex, v = spark.createDataFrame([("a", "L1")], "k string, level string"), spark.createDataFrame([("a", "S0", True), ("b", "S0", True), ("c", "S0", False)], "k string, level string, e boolean")
    assert rows(state.static_merge(ex, v, key="k", level="level", evidence="e")) == [("a", "L1", "existing"), ("b", "S0", "static")]


def test_labels(spark):
    vocab = spark.createDataFrame([("foo", "F", 2), ("bar", "B", 1)], "keyword string, reason string, priority int")
    df = spark.createDataFrame([(1, "a FOO bar"), (2, "foo ok"), (3, None), (4, "x")], "i int, t string")
    allow = spark.createDataFrame([("ok",)], "keyword string")
    lab = labels.label(df, vocab, id="i", text=F.coalesce("t", F.lit("")))
    assert rows(lab) == [(1, "B"), (2, "F")] and rows(labels.label(df, vocab, id="i", text=F.coalesce("t", F.lit("")), allow=allow)) == [(1, "B")]
    clean, hits = labels.quarantine(df, lab, "i")
    assert clean.count() == 2 and hits.count() == 2
    a = spark.createDataFrame([("x", False), ("x", None), ("y", False), ("z", None)], "k string, ok boolean")
    assert rows(labels.any_alive(a, by="k", ok="ok")) == [("x", True), ("y", False), ("z", True)]
    b = spark.createDataFrame([("g", 1, True, False), ("g", 1, False, True), ("g", 2, True, False), ("g", 2, False, False)], "g string, b int, h boolean, dead boolean")
    assert rows(labels.prune_blocks(b, block=["g", "b"], head=F.col("h"), dead=F.col("dead"))) == [("g", 2, False, False), ("g", 2, True, False)]
    with pytest.raises(ValueError):
        labels.require(a, 9, ["k"])
    with pytest.raises(ValueError):
        labels.require(a, 1, ["nope"])


def test_mirrors_against_brute_force(spark):
    r = random.Random(2)
    pool = [f"t{i}" for i in range(60)]
    data = []
    for i in range(80):
        base = pool[(i % 8) * 7 : (i % 8) * 7 + 10]
        names = [x if r.random() < 0.85 else r.choice(pool) for x in base]
        data.append((i, r.choice([1, 2]), names, r.choice([100, 110, 200, None]), r.choice(["http://a.example/x", "http://b.example/x", "csp_q"])))
    df = spark.createDataFrame(data, "id int, type int, names array<string>, total long, api string")
    host = lambda a: a.split("/")[2] if "://" in a else ""
    want = {}
    for x in data:
        for y in data:
            if x[0] < y[0] and x[1] == y[1] and len(set(x[2])) >= 5 and len(set(y[2])) >= 5:
                c, u = len(set(x[2]) & set(y[2])), len(set(x[2]) | set(y[2]))
                near = not (x[3] and y[3]) or abs(x[3] - y[3]) * 100 <= max(x[3], y[3]) * 15
                if c * 10 >= u * 8 and near:
                    want[(x[0], y[0])] = "library"
                elif host(x[4]) != host(y[4]) and c * 10 >= u * 5:
                    want[(x[0], y[0])] = "function"
    pairs = mirrors.mirror_pairs(df, id="id", type="type", titles="names", total="total", api="api")
    assert {(p.a, p.b): p.rule for p in pairs.collect()} == want and want
    up = {}

    def find(v):
        while up.setdefault(v, v) != v:
            v = up[v]
        return v

    for a, b in want:
        a, b = sorted((find(a), find(b)))
        up[b] = a
    want = sorted(((v, find(v)) for v in up), key=str)
    assert rows(mirrors.components(pairs)) == want == rows(mirrors.components(pairs, in_one_task=0))


def test_components_of_a_chain(spark):
    e = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a int, b int")
    for most in (0, 1000):
        got = {r.id: r.root for r in mirrors.components(e, in_one_task=most).collect()}
        assert set(got.values()) == {0, 100} and len(got) == 43
    assert mirrors.components(e.limit(0)).count() == 0


def test_long_vocabularies_use_an_automaton(spark):
    vocab = spark.createDataFrame([(f"word{i:04}x", f"r{i}", i) for i in range(700)] + [("aa", "first", -1)], "keyword string, reason string, priority int")
    df = spark.createDataFrame([(1, "has WORD0007x and word0003x"), (2, "AA word0001x"), (3, "none"), (4, None)], "i int, t string")
    assert rows(labels.label(df, vocab, id="i", text=F.coalesce("t", F.lit("")))) == [(1, "r3"), (2, "first")]


@pytest.mark.parametrize("most", [1, 2, 1000])
def test_block_pairs(spark, most):
    from heddle.operators.blocks import block_pairs

    df = spark.createDataFrame([("k", i, 7) for i in range(7)] + [("l", 1, 1)], "k string, i int, n int")
    got = rows(block_pairs(df, key=["k"], item="i", count="n", most=most))
    assert got == [(a, b) for a in range(7) for b in range(a + 1, 7)]


def test_overwrite_guards(spark):
    df = spark.createDataFrame([("a", False, "tool: x")] * 9 + [("a", None, "other")] + [("b", True, "tool: x")] + [("c", False, None)], "k string, ok boolean, m string")
    assert rows(labels.tool_failure(df, by=["k"], ok=F.col("ok"), message=F.col("m"), pattern="^tool")) == [("a", True), ("b", False), ("c", False)]
    v = spark.createDataFrame([(True, False), (False, True), (False, False), (False, False)], "local boolean, good boolean")
    may = lambda **k: labels.may_overwrite(v, local=F.col("local"), verdict=F.col("good"), floor=(1, 2), **k)
    assert not may(old_exists=True) and may(old_exists=False) and may(old_exists=True, force=True)
    p = spark.createDataFrame([("$.audit.x",), ("$.a",), (None,)], "p string")
    assert [r.e for r in p.select(labels.exempt(F.col("p"), ["audit"]).alias("e")).collect()] == [True, False, False]
