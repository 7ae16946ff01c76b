"""Links, gates, merges, indexes, rewriting, scrubbing, and the edges of readers and writers."""

import json

import pytest
from pyspark.sql import functions as F

from heddle import runtime
from heddle.functions import content, names, urls
from heddle.operators import catalog, dedup, history, joins, labels, state
from heddle.sources import documents


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_every_link_of_a_text_and_patterns(spark):
    t = " ".join(f"https://h.example/{i}.m3u" for i in range(201)) + " (https://x.test/a.png). https://y.example/b.json?q=1"
    df = frame(spark, [(t,), (None,), ("",)], "t string")
    got = [len(r[0]) for r in df.select(urls.harvest_links(F.col("t"))).collect()]
    assert got == [203, 0, 0]
    assert len(df.select(urls.harvest_links(F.col("t"), keep=r"\.json(\?|$)")).first()[0]) == 1
    assert len(df.select(urls.harvest_links(F.col("t"), drop=r"\.png$|\.json")).first()[0]) == 201


def test_links_keep_all_categories(spark):
    a = frame(spark, [("u", "A", "x", 2), ("u", "B", "y", 1), ("v", None, None, 3), ("", "A", "x", 1), (None, "A", "x", 1)], "url string, name string, g string, at int")
    b = frame(spark, [("u", "C", "x", 0)], "url string, name string, g string, at int")
    got = sorted(map(tuple, catalog.collect_links([(a, "live", F.col("g")), (b, "site", F.col("g"))], order="at").collect()))
    assert got == [("u", "live:x,live:y,site:x", "B"), ("v", "live", None)]
    assert catalog.collect_links([(a.limit(0), "live", F.col("g"))], order="at").count() == 0


def test_stale_rounds_are_ignored(spark):
    df = frame(spark, [("a", "2026-10-01 00:00:00", 5), ("a", "2026-09-20 00:00:00", 1), ("a", None, 1), ("a", "soon", 1), ("a", "2026-10-02 00:00:00", 9)], "item string, at string, v int")
    fresh = catalog.fresh_rounds(df, at="at", as_of="2026-10-03 00:00:00", days=3)
    assert [tuple(r) for r in catalog.round_winner(fresh, item="item", round="at", value="v").collect()] == [("a", 2, 9)]
    assert catalog.fresh_rounds(df, at="at", as_of="2026-11-03 00:00:00").count() == 0


def test_gates_in_their_order(spark):
    day = lambda n: f"2026-09-{n:02d}"
    probes = [(i, day(20 + k), ok) for i, oks in {"good": [True] * 4, "quar": [True] * 4, "lab": [True] * 4, "few": [True, None, True, True], "bad": [False, False, True, True], "rate": [False, True, True, True], "old": [False]}.items() for k, ok in enumerate(oks)] + [("old", day(1), False)]
    entries = [("good", "c", None), ("quar", "q", "x"), ("lab", "c", "x"), ("few", "c", None), ("bad", "c", None), ("rate", "c", None), ("old", "c", None), ("none", None, None)]
    run = lambda **k: {r.id: (r.action, r.reason) for r in history.promotion(frame(spark, entries, "id string, ch string, label string"), frame(spark, probes, "id string, at string, ok boolean"), id="id", channel="ch", label="label", quarantined=frame(spark, [("q",), (None,), ("",)], "ch string"), success="ok", at="at", as_of="2026-09-25", days=4, **k).collect()}
    got = run()
    assert got == {"good": ("promote", ""), "quar": ("keep", "quarantine"), "lab": ("keep", "label"), "few": ("keep", "days"), "bad": ("keep", "failures"), "rate": ("keep", "rate"), "old": ("reject", "days"), "none": ("keep", "days")}
    assert run(rate=(7, 10))["rate"] == ("promote", "")


def test_levels_only_improve_within_a_day(spark):
    entries = [("a", "u/a", "d1", "L2"), ("b", None, "d1", "L0"), ("c", "u/c", "d1", "L3"), ("e", "u/e", "d1", "X1")]
    rows = [("other", "u/a", "d1", "L3"), ("b", "u/b", "d1", "L1"), ("c", "u/zz", "d1", "L3"), ("c", "u/c", "d1", "L0"), ("c", "u/c", "d2", "L0"), ("c", "u/c", "d2", "L2"), (None, "u/n", "d1", "L1"), ("", "u/m", "d1", "L1"), (None, None, "d1", "L1")]
    got = sorted(map(tuple, joins.upsert_levels(frame(spark, entries, "n string, a string, d string, l string"), frame(spark, rows, "n string, a string, d string, l string"), name="n", address="a", day="d", level="l", best=["L3", "L2"]).collect()))
    assert got == [("a", "u/a", "d1", "L3"), ("b", "u/b", "d1", "L1"), ("c", "u/c", "d1", "L3"), ("c", "u/c", "d2", "L2"), ("e", "u/e", "d1", "X1"), ("u/m", "u/m", "d1", "L1"), ("u/n", "u/n", "d1", "L1"), ("u/zz", "u/zz", "d1", "L3")]


def test_ledger(spark):
    ledger = frame(spark, [("https://g.example/o/x.js", "deps/o/x.js"), (None, None)], "u string, f string")
    refs = ["https://g.example/o/x.js", "https://gh-proxy.com/https://g.example/o/x.js", "./deps/o/x.js", "https://g.example/o/x.js;md5;00", "http://x/api.php/provide/vod", "./none.js", "", None]
    got = {r.r: r.file for r in joins.ledger_resolve(frame(spark, [(r,) for r in refs], "r string"), ledger, ref="r", url="u", local="f", name="file").collect()}
    assert [got[r] for r in refs] == ["deps/o/x.js"] * 4 + [None] * 4


def test_index_plan(spark):
    prev = [("same", "P", "a", "1", True, "2026-10-01"), ("same", "P", "b", "1", False, "2026-10-01"), ("same", "P", "c", "1", False, "2026-08-25"), ("push", "P", "a", "1", True, "2026-10-01"), ("push", "P", "b", "1", True, "2026-10-01"), ("push", "P", "gone", "1", True, "2026-10-01"), ("lost", "P", "a", "1", True, "2026-10-01"), ("lost", "P", "b", "1", False, "2026-09-20"), ("away", "P", "a", "1", True, "2026-10-01"), ("away", "P", "z", "1", True, "2026-01-01")]
    repos = [("same", "P"), ("push", "Q"), ("lost", None), ("new", "R")]
    files = [("push", "a", "1"), ("push", "b", "2"), ("push", "n", "3"), ("new", "x", "1")]
    got = {(r.repo, r.path): r.action for r in state.index_plan(frame(spark, prev, "repo string, pushed_at string, path string, sha string, ok boolean, at string"), frame(spark, repos, "repo string, pushed_at string"), frame(spark, files, "repo string, path string, sha string"), as_of="2026-10-03").collect()}
    assert got == {("same", "a"): "reuse", ("same", "b"): "skip", ("same", "c"): "probe", ("push", "a"): "reuse", ("push", "b"): "probe", ("push", "gone"): "gone", ("push", "n"): "probe", ("lost", "a"): "reuse", ("lost", "b"): "skip", ("away", "a"): "reuse", ("away", "z"): "prune", ("new", "x"): "probe"}


def test_documents_are_rewritten_at_any_depth(spark):
    deep = "x"
    for _ in range(900):
        deep = [deep]
    docs = [{"sites": [{"jar": "x;md5;1$$$y"}, {"jar": "bad"}, {"jar": "z$$$bad;1"}, {"sub": {"sites": [{"a": "bad"}, {"a": " x "}]}}], "lives": ["bad", "x"], "n": 3, "e": None}, {"v": "bad$$$x;q$$$k"}, deep, "x"]
    rows = [(i, json.dumps(d)) for i, d in enumerate(docs)] + [(8, "no json"), (9, None)]
    got = {r.id: (r.text, r.removed) for r in catalog.rewrite_documents(frame(spark, rows, "id long, t string"), id="id", column="t", local={"x": "home/x"}, failed={"bad"}).collect()}
    assert json.loads(got[0][0]) == {"sites": [{"jar": "home/x;md5;1$$$y"}, {"sub": {"sites": [{"a": "home/x"}]}}], "lives": ["bad", "home/x"], "n": 3, "e": None} and got[0][1] == 3
    assert json.loads(got[1][0]) == {"v": "home/x;q$$$k"} and "home/x" in got[2][0] and got[3] == ('"home/x"', 0)
    assert got[8] == ("no json", 0) and got[9] == (None, 0)


def test_scrub(spark):
    lines = ["g,#genre#", "bad one,http://a", "ok,http://b", "#EXTINF:-1,bad two", "http://c", "http://d", "#EXTVLCOPT:x", "http://e", "#EXTINF:-1,fine", "http://f", "", None]
    df = frame(spark, [("f", i, x) for i, x in enumerate(lines)], "f string, i long, l string")
    assert [r.i for r in labels.scrub_lines(df, by="f", order="i", line="l", labelled=F.col("name").contains("bad")).orderBy("i").collect()] == [0, 2, 6, 7, 8, 9, 10, 11]


def test_cascade_and_age(spark):
    t = frame(spark, [("a", "2026-09-01"), ("b", "2026-10-01"), ("c", " ")], "k string, seen string")
    kept, checks = state.stale_cascade(t, frame(spark, [("a", 1), ("b", 1), (None, 1)], "k string, n int"), key="k", seen="seen", as_of="2026-10-02", grace=7)
    assert sorted(r.k for r in kept.collect()) == ["b", "c"] and sorted(str(r.k) for r in checks.collect()) == ["None", "b"]
    at = frame(spark, [("2026-10-01 00:00:00",), (None,)], "at string")
    assert labels.require(at, 1, [], at="at", as_of="2026-10-02 00:00:00", hours=24) is at
    for df in (at, at.where("at is null")):
        with pytest.raises(ValueError):
            labels.require(df, 1, [], at="at", as_of="2026-10-03 00:00:00", hours=24)


def test_a_hot_key_is_ranked_over_pieces(spark):
    rows = [(i, "Key", f"http://a/{i % 50}") for i in range(300)] + [(1000, "other", None)]
    df = frame(spark, rows, "i long, k string, a string")
    whole = {r.i: r.new_key for r in dedup.rename_keys(df, key="k", api="a", order=["i"]).collect()}
    assert whole == {0: "Key", 1000: "other"} | {i: f"key-{i + 1}" for i in range(1, 50)}
    ranked = history.rank_in_pieces(df, by=["k"], order="i", name="r", piece=7)
    assert {r.i: r.r for r in ranked.collect()} == {i: i + 1 for i in range(300)} | {1000: 1}


def test_differences_are_counted(spark):
    a, b = frame(spark, [("s", 1), ("s", 2), ("s", 2), ("t", 1), (None, 1)], "s string, k int"), frame(spark, [("s", 2), ("s", 3)], "s string, k int")
    assert {r.s: r.n for r in joins.symmetric_count(a, b, by="s", item="k").collect()} == {"s": 2, "t": 1, None: 1}


def test_json_has_one_form(spark):
    rows = [('{"b": " x ", "a": [1, {"d": 1, "c": null}]}',), ('{"a":[1,{"c":null,"d":1}],"b":"x"}',), ("no",), (None,), ('" é "',)]
    got = [r[0] for r in frame(spark, rows, "t string").select(content.canonical_json(F.col("t"))).collect()]
    assert got == ['{"a":[1,{"c":null,"d":1}],"b":"x"}'] * 2 + [None, None, '"é"']


def test_all_traditional_characters(spark):
    source, target = names.traditional_table(spark)
    assert len(source) == len(target) > 2000
    got = frame(spark, [("憂鬱的臺灣烏龜 電視臺",)], "n string").select(names.normalize_name(F.col("n"), (source, target))).first()[0]
    assert got == "忧郁的台湾乌龟电视台"


def test_too_large_a_document_is_an_error(spark):
    df = frame(spark, [(1, b"plain text"), (2, b"y" * 100), (3, None)], "i int, b binary")
    got = {r.i: (r.d if r.d is None else bytes(r.d), r.d_error) for r in documents.decoded(df, "b", "d", most_bytes=50).collect()}
    assert got[1] == (b"plain text", None) and got[2][0] is None and "50" in got[2][1] and got[3] == (None, None)


def test_reports_say_what_they_leave_out(spark):
    df = spark.range(5)
    assert "3 more rows" in documents.markdown_table(df, most=2) and "3 more rows" in documents.html_table(df, "t", most=2)
    assert "more rows" not in documents.markdown_table(df, most=5)


def test_replaced_json_may_be_read_while_it_is_replaced(spark, tmp_path):
    path = str(tmp_path / "doc")
    documents.replace_json(spark.range(3), path)
    documents.replace_json(spark.read.json(path).where("id > 0"), path)
    assert sorted(r.id for r in spark.read.json(path).collect()) == [1, 2] and [p.name for p in tmp_path.iterdir()] == ["doc"]


def test_rules_are_the_same_bytes(spark, tmp_path):
    v = frame(spark, [("d", "k", "b"), ("d", "k", "a"), ("d", "k", "a"), ("d", None, "x"), ("e", "z", "1"), ("e", "a", "2")], "doc string, k string, v string")
    run = lambda df: {r.document: r.json for r in documents.rule_documents(df, document="doc", key="k", value="v").collect()}
    assert run(v) == {"d": '{"k":["a","b"]}', "e": '{"a":["2"],"z":["1"]}'} == run(v.orderBy(F.desc("v")))
    for df in (v, v.where("doc = 'e'")):
        documents.write_rules(documents.rule_documents(df, document="doc", key="k", value="v"), str(tmp_path / "r"))
    assert {r.document: r.value for r in spark.read.text(str(tmp_path / "r")).collect()} == run(v)


def test_ratio_of_a_sample(spark):
    assert history.hash_sample(spark.range(100), "id", "s", ratio=(1, 10)).count() == 10
    assert history.hash_sample(spark.range(3), "id", "s", ratio=(1, 10)).count() == 1


def test_scratch_drops_its_tables(spark):
    with runtime.scratch(spark):
        df = runtime.durable(spark.range(3))
        path = df.inputFiles()[0].rsplit("/", 1)[0]
        assert df.count() == 3 and documents.exists(spark, path)
    assert not documents.exists(spark, path)


def test_hosts_of_addresses_with_line_breaks(spark):
    df = frame(spark, [("http://bücher.example:80/a\nb",), ("http://plain.example/é\n",), ("ü",), (None,)], "u string")
    assert [r.s for r in documents.requestable_hosts(df, "u", "s").collect()] == ["http://xn--bcher-kva.example:80/a\nb", "http://plain.example/é\n", "ü", None]
