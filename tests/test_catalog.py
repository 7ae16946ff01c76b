import io
import zipfile

import pytest
from pyspark.sql import functions as F

from heddle.functions.names import dated_name
from heddle.operators import catalog
from heddle.sources import documents


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_targets_and_grades(spark):
    df = spark.createDataFrame([(1, "./a.js", "x http://good.test/y"), (2, "http://github.com/x", "http://localhost/1"), (3, "http://ok.test/z", None), (4, None, None), (5, "./r.js", "")], "i int, api string, ext string")
    got = {r.i: (r.t.target, r.t.source) for r in df.select("i", catalog.target_of(F.col("api"), F.col("ext")).alias("t")).collect()}
    assert got == {1: ("http://good.test/y", "ext"), 2: (None, "no address"), 3: ("http://ok.test/z", "api"), 4: (None, "no address"), 5: (None, "no trusted address in rule")}
    g = spark.createDataFrame([(False, True, 9, True), (True, None, 9, True), (True, True, 2, True), (True, True, 3, None), (True, True, 3, True)], "a boolean, b boolean, c int, d boolean")
    assert [r.g for r in g.select(catalog.static_grade(F.col("a"), F.col("b"), F.col("c"), F.col("d")).alias("g")).collect()] == ["P0", "P1", "P2", "P3", "P4"]


def test_locate_sites(spark):
    docs = ['{"sites":[{"key":1}]}', '{"data":{"sites":[1,2]}}', '{"video":[1,2,3]}', '[{"api":"x"},{"q":1}]', "{bad", None]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(docs)], "i int, t string")
    got = [None if r.s is None else len(r.s) for r in df.select("i", catalog.locate_sites(F.col("t")).alias("s")).orderBy("i").collect()]
    assert got == [1, 2, 3, 1, None, None]


def test_blobs_prefixes_alternates(spark):
    b = spark.createDataFrame([("g", f"p{i}.json", 1000 + i) for i in range(12)] + [("g", "package.json", 9000), ("g", "x.md", 9000), ("g", "s.json", 10)], "g string, p string, n long")
    assert [r.p for r in catalog.prefer_blobs(b, group="g", path="p", size="n").orderBy("n").collect()] == [f"p{i}.json" for i in range(11, 3, -1)]
    p = spark.createDataFrame([("https://a.test/",), ("https://b.test/",)], "p string")
    u = spark.createDataFrame([("https://a.test/https://x.test/1", "timeout"), ("https://y.test/2", "404")], "u string, f string")
    assert rows(catalog.alternates(u, p, url="u", prefix="p", failure="f", environment=["timeout"])) == [("https://a.test/https://x.test/1", "https://b.test/https://x.test/1")]
    h = spark.createDataFrame([("https://m.test/https://raw.test/x and http://n.test/http://q",), (None,)], "t string")
    assert [r.h for r in h.select(catalog.prefix_hosts(F.col("t")).alias("h")).collect()] == [["m.test", "n.test"], []]


def test_segments(spark):
    df = spark.createDataFrame([("a$$$b$$$c", {"a": "12345", "b": "1"}, {"a": "L"}, ["c"])], "t string, m map<string,string>, l map<string,string>, f array<string>")
    r = df.select(catalog.inline_segments(F.col("t"), F.col("m"), 2, 9).alias("i"), catalog.rewrite_segments(F.col("t"), F.col("l"), F.col("f")).alias("r"), catalog.rewrite_segments(F.lit("c"), F.col("l"), F.col("f")).alias("n")).first()
    assert tuple(r.i) == ("12345$$$b$$$c", "inlined,small,kept") and r.r == "L$$$b" and r.n is None
    s = spark.createDataFrame([("x/TV /y",), ("xTV",), (None,)], "t string")
    assert [r.h for r in s.select(catalog.segment_label(F.col("t"), "TV").alias("h")).collect()] == [True, False, False]
    a = spark.createDataFrame([("vocab/x", "bad"), ("f.txt", "bad"), ("f.txt", "bad but ok"), ("bad.jar", "x"), ("f.jar", "bad")], "e string, v string")
    assert [r.v for r in a.select(catalog.archive_verdict(F.col("e"), F.col("v"), "bad", "ok").alias("v")).collect()] == ["skipped", "word", "guarded", "word", "clean"]


def test_retention_trust_alias(spark):
    n = spark.createDataFrame([("v2026-01-01-b1",), ("v2026-09-30-b1",), ("odd",), ("v2025-01-01-b2",)], "name string")
    k = spark.createDataFrame([("v2025-01-01-b2",)], "name string")
    assert rows(catalog.retention(n, k, name="name", day=dated_name(F.col("name")), as_of="2026-10-05", days=30)) == [("odd", "keep"), ("v2025-01-01-b2", "keep"), ("v2026-01-01-b1", "delete"), ("v2026-09-30-b1", "keep")]
    t = spark.createDataFrame([("a", "C0", None), ("b", "C0", True), ("c", "L3", None), ("d", None, None)], "k string, level string, e boolean")
    assert [r.k for r in catalog.trusted_rows(t, level="level", evidence=F.col("e")).orderBy("k").collect()] == ["b", "c", "d"]
    ex, new = spark.createDataFrame([("a", "A")], "x string, t string"), spark.createDataFrame([("a", "Z"), ("b", "C"), ("b", "B"), (None, "Q")], "x string, t string")
    once = catalog.alias_merge(ex, new, alias="x", target="t")
    assert rows(once) == [("a", "A"), ("b", "B")] == rows(catalog.alias_merge(once, new, alias="x", target="t"))
    s = catalog.link_streams(spark.createDataFrame([("a",), ("q",), (None,)], "c string"), ex, channel="c", id="x")
    assert {r.c: r.orphan for r in s.collect()} == {"a": False, "q": True, None: True}


def test_rounds_protection_duplicates(spark):
    m = spark.createDataFrame([("a", 1, 5), ("a", 2, 9), ("a", 3, 7), ("b", 1, 99), ("c", 1, 1), ("c", 2, 8)], "p string, r int, v int")
    assert [tuple(r) for r in catalog.round_winner(m, item="p", round="r", value="v").collect()] == [("c", 2, 8), ("a", 3, 7)]
    c = spark.createDataFrame([("Dep/A.jar",), ("dep/sub/x",), ("dep/y",), ("other/z",)], "p string")
    live = spark.createDataFrame([("dep/a.jar",), ("DEP/sub/",)], "p string")
    assert rows(catalog.protect(c, live, path="p")) == [("dep/y",), ("other/z",)]
    f = spark.createDataFrame([("a", 3, "xyz"), ("b", 3, "xyz"), ("c", 3, "abc"), ("d", 1, "q")], "p string, n int, t string")
    assert [(r.first, r.copies) for r in catalog.two_phase_duplicates(f, path="p", size="n", content="t").collect()] == [("a", 2)]


def test_text_pruning_and_alerts(spark):
    data = [("f", 1, "G,#genre#", None), ("f", 2, "a,u", "dead"), ("f", 3, "H,#genre#", None), ("f", 4, "b,u", None), ("f", 5, "c,u", "alive"), ("f", 6, "d,u", "dead")]
    df = spark.createDataFrame(data, "f string, o long, line string, s string")
    got = catalog.prune_text(df, by="f", order="o", line="line", dead=F.col("s") == "dead", alive=F.col("s") == "alive")
    assert [r.line for r in got.orderBy("block", "place").collect()] == ["H,#genre#", "c,u", "b,u"]
    cur = spark.createDataFrame([("a", 9, 5), ("b", 9, 5), ("c", 1, 5)], "m string, v int, l int")
    assert rows(catalog.alert_once(cur, spark.createDataFrame([("b",)], "m string"), metric="m", value="v", limit="l")) == [("a", True), ("b", False), ("c", False)]
    ages = spark.createDataFrame([("2026-10-01 00:00:00",), ("bad",), (None,)], "t string")
    assert [r.h for r in ages.select(catalog.artefact_age(F.col("t"), "2026-10-01 06:00:00").alias("h")).collect()] == [6.0, 999.0, 999.0]


def test_layers(spark):
    s = spark.createDataFrame([(1, "a", "k", "u", 1, None), (2, "a", "K", "U", 1, None), (3, "b", "k", "u", 1, None), (4, "a", "z", "u", 1, ""), (5, "a", "", "q", 1, "")], "i int, src string, key string, api string, type int, jar string")
    src = spark.createDataFrame([("b", True), ("a", False)], "name string, decayed boolean")
    assert [tuple(r)[1:] for r in catalog.layered_dedup(s, src, order="i").orderBy("layer").collect()] == [("raw", 5), ("decay", 4), ("key", 2), ("fingerprint", 1)]


def test_archives_reports_lists(spark, tmp_path):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("b/C.class", "x")
        z.writestr("a.txt", "y")
    df = spark.createDataFrame([("ok", buf.getvalue()), ("bad", b"nope"), ("none", None)], "p string, c binary")
    got = {r.path: (r.error, r.entries) for r in documents.archive_entries(df, path="p", content="c").collect()}
    assert got["ok"] == (None, ["a.txt", "b/C.class"]) and got["bad"] == ("BadZipFile", None) == got["none"]
    (tmp_path / "list").write_bytes("a b\0山/x\0".encode())
    assert rows(documents.read_nul_list(spark, str(tmp_path / "list"))) == [("a b",), ("山/x",)]
    t = spark.createDataFrame([("<a>", 1)], "k string, v int")
    assert "&lt;a&gt;" in documents.html_table(t, "T")
    documents.append_jsonl(t, str(tmp_path / "j"))
    documents.append_jsonl(t, str(tmp_path / "j"))
    assert documents.load_jsonl(spark, str(tmp_path / "j"), "k string, v int").count() == 2
    documents.export_subsets(t, str(tmp_path / "s"), ["v"])
    assert spark.read.parquet(str(tmp_path / "s" / "v=1")).count() == 1


def test_entry_registers_everything():
    import __spark_entry__ as e

    q, s = e.queries(), e.oracle_sql()
    assert set(s) <= set(q) and len(q) > 100 and {"p5_found", "p6_found"} <= set(q)


@pytest.mark.parametrize("name", ["p5_found"])
def test_entry_runs(spark, name):
    import __spark_entry__ as e

    assert e.entry(spark).columns == ["snapshot_date", "key", "change_kind"]
