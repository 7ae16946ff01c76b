import datetime as dt

import pytest
from pyspark.sql import functions as F

from heddle.functions import content, grades, names, urls


def ev(spark, f, *values):
    """The function of columns applied to one row of values."""
    df = spark.range(1).select(*[F.lit(v).alias(f"c{i}") for i, v in enumerate(values)])
    return df.select(f(*[F.col(f"c{i}") for i in range(len(values))]).alias("r")).first().r


def col(spark, f, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.r for r in df.select("i", f(F.col("v")).alias("r")).orderBy("i").collect()]


def test_canonical_url(spark):
    given = ["https://GHProxy.net/https://raw.githubusercontent.com/A/B/main/c.json", "http://www.Example.com:80/x/", "https://api.example.com:443/v1?a=1#frag", "http://h.example:443/", None, "", "\n http://A.example/Q \t", "csp_X"]
    want = ["raw.githubusercontent.com/A/B/main/c.json", "example.com/x", "api.example.com/v1?a=1", "h.example:443", "", "", "a.example/Q", "csp_x"]
    assert col(spark, urls.canonical_url, given) == want
    assert col(spark, urls.norm_url, ["csp_X", "http://A.example/"]) == ["csp_X", "a.example"]


def test_endpoint_and_host(spark):
    assert col(spark, urls.parse_url_norm, ["HTTP://A.Example/Q//", "https://B.example", "Web", "ftp://X/y", None]) == ["https://a.example/Q", "https://b.example", "Web", "ftp://X/y", ""]
    assert col(spark, urls.host_of, ["https://U:p@Host.Example:81/x", "no", None]) == ["host.example:81", "", ""]


def test_paths_and_references(spark):
    assert col(spark, urls.path_norm, ["./a//b\\c", ".././x", None]) == ["a/b/c", "x", ""]
    assert col(spark, urls.bare_ref, ["./a.jar;md5;ff", "https://ghproxy.net/https://h.example/a;MD5;1"]) == ["./a.jar", "https://h.example/a"]
    assert col(spark, urls.split_refs, ["./a;x$$$ http://b $$$../c", None, "图/./d"]) == [["./a", "../c"], [], []]
    assert col(spark, urls.remote_list, ["http://a.example/x,https://127.0.0.1/y http://192.168.1.2/z", None]) == [["http://a.example/x"], []]
    assert col(spark, urls.url_class, [None, "./a", "https://github.com/x", "rtsp://x/y", "n/a"]) == ["no_url", "local", "gh", "direct", "no_url"]
    assert col(spark, urls.quote_path, ["https://h.example/a b/山?q=1 2"]) == ["https://h.example/a%20b/%E5%B1%B1?q=1 2"]
    assert col(spark, urls.repo_ref, ["https://ghproxy.net/https://raw.githubusercontent.com/o/r/main/d/f.json", "https://raw.githubusercontent.com/o/r/main/../x", "x"])[0].asDict() == {"owner": "o", "repo": "r", "ref": "main", "path": "d/f.json"}
    assert col(spark, urls.repo_ref, ["https://raw.githubusercontent.com/o/r/main/../x", "x"]) == [None, None]
    assert ev(spark, urls.miss_reason, 404, "/a/b.json", False) == "gone-404" and ev(spark, urls.miss_reason, 404, "/", False) == "" and ev(spark, urls.miss_reason, 200, "/a.js", True) == "lander-html"
    assert col(spark, urls.harvest_links, ["see http://a.example/x. and http://a.example/x, (https://b.example)"]) == [["http://a.example/x", "https://b.example"]]


def test_names(spark):
    a, b = col(spark, names.normalize_name, ["【高清】CCTV-1 综合", "cctv1综合"])
    assert a == b
    assert col(spark, names.title_norm, ["CCTV-1 综合!", None]) == ["cctv1综合", ""]
    assert col(spark, names.latency_label, ["[590ms|5] x", "x", None, "[99999999999ms]"]) == [590, None, None, None]
    assert col(spark, names.group_core, ["综合-电影", "4K-x", None]) == ["电影", "x", ""]
    assert ev(spark, names.upstream_tag, "a/12-abcdefghijklmnop", "k") == "abcdefghijkl" and ev(spark, names.upstream_tag, "", "abcdefghij") == "abcdefgh" and ev(spark, names.upstream_tag, "", "") == "unk"
    assert ev(spark, names.quality_score, "[5ms] x", 1, 1, "a") == 20
    assert col(spark, names.dated_name, ["snapshot-20260131.zip", "v2026-02-03-b4", "snapshot-20261399.zip", "x", None]) == [dt.date(2026, 1, 31), dt.date(2026, 2, 3), None, None, None]
    assert col(spark, names.safe_segment, ["a<b", "CON.txt", "x. ", "", None]) == ["a_b", "_CON.txt", "x", "_", "_"]
    assert col(spark, names.safe_path, ["a/../b\\c", "", None]) == ["a/b/c", "_", "_"]
    assert col(spark, names.windows_reason, ["a/b", "", "a//b", "a?b", "x ", "nul.txt", "y" * 300]) == ["", "empty path", "empty segment", "illegal character", "ends with dot or space", "reserved name", "too long"]
    long = "d/" + "x" * 300 + ".json"
    (short,) = col(spark, names.capped_path, [long])
    assert short.startswith("d/") and short.endswith(".json") and len(short) == 23
    df = spark.createDataFrame([("CCTV-5+", ""), ("CCTV-18", ""), ("香港台", ""), ("电影轮播", ""), ("新闻轮播", ""), ("X卫视", ""), ("CCTV-1", "abroad"), ("z", None)], "n string, m string")
    assert [r.r for r in df.select(names.channel_class(F.col("n"), F.col("m")).alias("r")).collect()] == ["numbered", "other", "region", "loop", "other", "local", "source:abroad", "other"]


def test_contents(spark):
    import hashlib

    for s, n in (("abc", 977), ("2026-10-14", 37), ("", 5)):
        assert ev(spark, lambda c, n=n: content.md5_mod(c, n), s) == int(hashlib.md5(s.encode()).hexdigest(), 16) % n
        assert ev(spark, lambda c, n=n: content.sha1_mod(c, n), s) == int(hashlib.sha1(s.encode()).hexdigest(), 16) % n
    assert ev(spark, content.sketch_value, "a") == int(hashlib.md5(b"a").hexdigest()[:12], 16) % 2**32
    kinds = [b"PK\x03\x04xx", b"\x1f\x8b0", b"  <!DOCTYPE x", b"<html>", b"\n{}", b"plain", "山".encode(), b"", None]
    assert col(spark, content.magic_kind, kinds, "binary") == ["jar", "gzip", "html", "html", "json", "text", "binary", "text", None]
    packet = b"\x47" + b"\0" * 187 + b"\x47" + b"\0" * 187
    assert col(spark, content.looks_like_stream, [packet, b"#EXTM3U\n", b"FLV\x01", b"{}", b"", None], "binary") == [True, True, True, False, False, False]
    assert ev(spark, content.suffix_mismatch, "a/x.jar", "html") and not ev(spark, content.suffix_mismatch, "a/x.jar", "jar") and ev(spark, content.suffix_mismatch, "x.png", "jar") and not ev(spark, content.suffix_mismatch, "x.zip", "jar")
    assert col(spark, content.body_shape, ["#EXTM3U", "a,#genre#\nb,c", "<!doctype html>", " [1]", "\ufeff{", "x", None]) == ["live", "live", "html", "json", "bom", "other", "other"]
    assert ev(spark, content.response_class, 200, "{}") == "E2" and ev(spark, content.response_class, 200, "<html>") == "E1" and ev(spark, content.response_class, 404, "") == "E0" and ev(spark, content.response_class, 302, "") == "E?"
    assert col(spark, content.is_rule, ['{"a":1}', "<!DOCTYPE html>", " ", "<?xml?>", None]) == [True, False, False, True, False]


def test_grades(spark):
    assert col(spark, grades.level_health, ["C3", "S1", "S0", "E?", None, "zz", "P3"]) == ["healthy", "degraded", "dead", "unknown", "unknown", "unknown", "degraded"]
    assert col(spark, grades.level_rank, ["L3", "L2", "L1", "S0", None]) == [0, 2, 2, 6, 7] or col(spark, grades.level_rank, ["L3", "L2", "L1", "S0", None]) == [0, 1, 2, 6, 7]
    assert ev(spark, grades.funnel_grade, True, True, True, True, True) == "D5"
    assert ev(spark, grades.funnel_grade, False, True, True, False, True) == "D3"
    assert ev(spark, grades.funnel_grade, False, False, False, False, True) == "D0"
    got = [tuple(r) for r in col(spark, grades.deep_verdict, ["G2", "G0", "C0", None, "stub-x", "S1"])]
    assert got == [("C2", ""), (None, "g0"), (None, "load"), ("C?", ""), (None, "stub"), ("S1", "")]
    assert col(spark, lambda c: grades.days_since(c, "2026-10-05"), ["2026-10-01", "", None, "x"]) == [4, 9999, 9999, 9999]
    assert col(spark, grades.grace_days, [2 << 20, 200 << 10, 5], "long") == [7, 14, None]
    assert col(spark, grades.site_kind, ["我的蜘蛛", "短剧", "直连1", None]) == ["csp", "short", "std", "other"]
    assert col(spark, grades.fail_limit, ["404", "timeout", "zz"]) == [2, 5, 3]


@pytest.mark.parametrize("a,b,same", [((" x ", "1"), ("x", "1"), True), (("x", None), ("x", ""), False), (("x", "1"), ("1", "x"), False)])
def test_canonical_hash(spark, a, b, same):
    df = spark.createDataFrame([a, b], "p string, q string")
    x, y = [r.h for r in df.select(content.canonical_hash("q", "p").alias("h")).collect()]
    assert (x == y) == same
