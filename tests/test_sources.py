import base64
import gzip
import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

from heddle.runtime import shared_dir
from heddle.sources import documents, playlist
from heddle.streaming import ingest

PLAYLIST = """#EXTM3U
#EXTINF:-1 tvg-id="a" group-title="News",One
http://a.example/1
http://a.example/2

#EXTGRP:x
#EXTINF:-1,Two
rtsp://b.example/3
Sport,#genre#
Three,http://c.example/4#http://c.example/5
banner
Four,not-an-address
"""


@pytest.mark.parametrize("end", ["\n", "\r\n", "\x0b", "\x85", "\u2028"])
def test_playlist(spark, end):
    df = spark.createDataFrame([("f", PLAYLIST.replace("\n", end)), ("g", None), ("h", "")], "file string, text string")
    got = [(r.name, r.group_name, r.url) for r in playlist.parse_playlists(df).orderBy("file", "line_no", "pos").collect()]
    assert got == [("One", "News", "http://a.example/1"), ("One", "News", "http://a.example/2"), ("Two", "", "rtsp://b.example/3"), ("Three", "Sport", "http://c.example/4"), ("Three", "Sport", "http://c.example/5")]


def test_merge_and_write(spark, tmp_path):
    c = spark.createDataFrame([("One", "g", "u1", 30, 1), ("one", "g", "u2", 10, 2), ("One", "g", "u1", 20, 3), ("Two", None, "u3", None, 4)], "name string, g string, url string, ms int, o int")
    m = playlist.merge_channels(c, key=F.lower("name"), name="name", url="url", order=["o"])
    assert {r.key: (r.name, r.urls) for r in m.collect()} == {"one": ("One", ["u1", "u2"]), "two": ("Two", ["u3"])}
    lines = [r.value for r in playlist.m3u_lines(c, name="name", group="g", url="url", speed="ms").collect()]
    assert [x.split("\n")[1] for x in lines] == ["u2", "u1", "u3"]
    (tmp_path / "p.m3u").write_bytes(PLAYLIST.encode() + b"\xff\xfe")
    assert playlist.parse_playlists(playlist.read_texts(spark, str(tmp_path))).count() == 5


def test_json_readers(spark, tmp_path):
    p = tmp_path / "a.json"
    p.write_text('{"k": "x",\n "n": 1}')
    bad = tmp_path / "b.json"
    bad.write_text("{oops")
    assert [tuple(r) for r in documents.load_json(spark, str(p), "k string, n int").collect()] == [("x", 1)]
    assert documents.load_json(spark, str(bad), "k string, n int").count() == 0 and documents.load_json(spark, str(tmp_path / "none.json"), "k string").count() == 0
    lines = tmp_path / "l.jsonl"
    lines.write_text('{"url": "a", "n": 1}\nbad\n{"url": "b", "n": 2}\n{"url": "a", "n": 3}\n')
    assert documents.load_jsonl(spark, str(lines), "url string, n int").count() == 3
    assert sorted(map(tuple, documents.last_per_key(spark, str(lines), "url string, n int", "url").collect())) == [("a", 3), ("b", 2)]


def test_inventory_registry_versions(spark, tmp_path):
    (tmp_path / "x.jar").write_bytes(b"PK\x03\x04")
    (tmp_path / "y.txt").write_bytes(b"{}")
    got = {r.path.rsplit("/", 1)[1]: (r.length, r.kind) for r in documents.inventory(spark, str(tmp_path), content=True).collect()}
    assert got == {"x.jar": (4, "jar"), "y.txt": (2, "json")}
    reg = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    assert sorted(map(tuple, documents.upsert_registry(reg, spark.createDataFrame([("b", 9), ("c", 3)], "k string, v int"), "k").collect())) == [("a", 1), ("b", 9), ("c", 3)]
    out = documents.write_version(reg, str(tmp_path / "v"), "2026-01-01")
    assert spark.read.parquet(out).count() == 2
    assert documents.markdown_table(reg.orderBy("k")) == "| k | v |\n| --- | --- |\n| a | 1 |\n| b | 2 |\n"


def test_decode(spark):
    plain = b'{"sites": []}'
    one = b"8q2**" + base64.b64encode(plain)
    cases = [plain, base64.b64encode(plain * 3), gzip.compress(plain), one, base64.b64encode(gzip.compress(one)), b"", b"\x1f\x8bbroken", None, b"short"]
    want = [plain, plain * 3, plain, plain, plain, b"", b"\x1f\x8bbroken", None, b"short"]
    assert [documents.decode_layers(c) for c in cases] == want
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, c binary")
    assert [r.d if r.d is None else bytes(r.d) for r in documents.decoded(df, "c", "d").orderBy("i").collect()] == want
    deep = plain
    for _ in range(9):
        deep = base64.b64encode(deep)
    assert documents.decode_layers(deep) != plain


def test_hosts_json_paths_private_fields(spark):
    df = spark.createDataFrame([(1, "http://例え.example:81/パス?q=%20"), (2, "http://a.example/x"), (3, None)], "i int, u string")
    assert [r.h for r in documents.requestable_hosts(df, "u", "h").orderBy("i").collect()] == ["http://xn--r8jz45g.example:81/パス?q=%20", "http://a.example/x", None]
    doc = {"a": ["http://x.example/1", {"b": "https://y.example"}], "c": "no"}
    j = spark.createDataFrame([(1, json.dumps(doc)), (2, "{bad"), (3, None)], "i int, t string")
    assert sorted(map(tuple, documents.json_urls(j, id="i", column="t").collect())) == [(1, "$.a[0]", "http://x.example/1"), (1, "$.a[1].b", "https://y.example")]
    s = spark.createDataFrame([(1, 2, {"_x": 1, "y": 2}, [{"_z": 1, "w": 2}])], "a int, _b int, c struct<_x: int, y: int>, d array<struct<_z: int, w: int>>")
    assert documents.strip_private(s).schema.simpleString() == "struct<a:int,c:struct<y:int>,d:array<struct<w:int>>>"
    r = spark.range(1).select(documents.rewrite_references(F.lit("see ./a/b.js and ./a"), [("./a", "./Z"), ("./a/b.js", "./Q")]).alias("t"))
    assert r.first().t == "see ./Q and ./Z"


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_streams(spark, tmp_path):
    schema = "k string, priority int, rank int, evidence boolean, level string, at timestamp"
    at = pd.Timestamp("2026-01-01")
    for i, part in enumerate(([("a", 2, 0, False, "L3"), ("b", 2, 6, False, "S0")], [("a", 4, 6, False, "S0"), ("b", 1, 1, False, "L2")])):
        pdf = pd.DataFrame([(*r, at + pd.Timedelta(hours=i)) for r in part], columns=["k", "priority", "rank", "evidence", "level", "at"])
        spark.createDataFrame(pdf, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    s = ingest.read_drops(spark, str(tmp_path / "in"), schema, files_per_trigger=1)
    q = ingest.stream_verdicts(s, key="k").writeStream.outputMode("update").format("memory").queryName("verdicts").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    last = {}
    for r in spark.sql("select * from verdicts").collect():
        last.setdefault(r.k, []).append(r.level)
    assert last["a"][-1] == "S0" and last["b"] == ["L2"]
    n = ingest.hourly_counts(s, at="at", kind="level").writeStream.outputMode("update").format("memory").queryName("hours").option("checkpointLocation", str(tmp_path / "cp2")).trigger(availableNow=True).start()
    n.awaitTermination(120)
    assert spark.sql("select sum(n) as n from (select max(n) as n from hours group by window, level)").first().n == 4
