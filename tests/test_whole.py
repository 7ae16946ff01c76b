"""Queries and operators return every row: no cap, no sample, no lost part."""

import io
import struct
import zipfile

import pytest
from pyspark.sql import functions as F

from heddle.operators import joins, labels, packed
from heddle.plans import catalog as plans
from heddle.plans import tables as table_plans
from heddle.plans import texts as text_plans
from heddle.sources import documents


def save(spark, folder, **tables):
    for name, (data, schema) in tables.items():
        spark.createDataFrame(data, schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_rankings_and_folders_have_no_cap(spark, tmp_path):
    sites = [(i, f"https://h{i}.example/", 1, f"o{i:03}") for i in range(250)]
    d = save(
        spark,
        tmp_path,
        sites=(sites, "row_id long, api string, type int, origin string"),
        sites_probe=([(i, f"https://h{i}.example/", i + 1) for i in range(0, 250, 5)], "probe_id long, api string, ms int"),
        documents=([(i, "zh", f"s{i:02}", 10 + i) for i in range(30)], "doc_id long, lang string, source string, n_chars int"),
    )
    ranked = [r.row_id for r in plans.parse_ranking(spark, d).collect()]
    assert sorted(ranked) == list(range(250)) and ranked[0] == 0  # probe 0 is ok and the fastest
    assert [r.folder for r in plans.folder_bytes(spark, d).collect()] == [f"zh/s{i:02}" for i in range(29, -1, -1)]
    assert [r.origin for r in plans.candidate_rank(spark, d).collect()] == [f"o{i:03}" for i in range(250)]


def test_located_sites_counts_every_pair_of_a_source(spark, tmp_path):
    pairs = [(s, f"k{i}", f"https://{i}.example/") for s, n in (("a", 2500), ("b", 3), (None, 7)) for i in range(n)]
    d = save(spark, tmp_path, sites=(pairs + pairs[:40] + [("b", None, None)], "src string, key string, api string"))
    assert {r.src: r.n for r in plans.located_sites(spark, d).collect()} == {"a": 2500, "b": 4, None: 7}


def test_links_come_from_arrays_and_nested_documents(spark, tmp_path):
    texts = ['["https://a.example/1", {"x": ["http://b.example/2"]}]', '{"u": {"v": "https://c.example/3"}}', '"https://d.example/4"', "https://no.example/json", "[broken", None]
    d = save(spark, tmp_path, sites=(list(enumerate(texts)), "row_id long, ext string"))
    want = [(0, "$[0]", "https://a.example/1"), (0, "$[1].x[0]", "http://b.example/2"), (1, "$.u.v", "https://c.example/3"), (2, "$", "https://d.example/4")]
    assert sorted(map(tuple, text_plans.json_references(spark, d).collect())) == want
    assert sorted(map(tuple, table_plans.audited_links(spark, d).collect())) == [(p, 1) for p in sorted(p for _, p, _ in want)]


def test_cascade_is_exact_then_basename_then_prefix(spark):
    left = spark.createDataFrame([(x,) for x in ("deps/ab.jar", "old/moved.jar", "x.js", "deps/long/na", "none.txt", "end/", None)], "l string")
    right = spark.createDataFrame([(x,) for x in ("deps/ab", "deps/ab.jar", "new/moved.jar", "newer/moved.jar", "old/mo", "x.js", "deps/long/name.py", "other/", "none")], "f string")
    got = {r.l: r.file for r in joins.cascade_match(left, right, left="l", right="f", length=6, name="file").collect()}
    assert got == {"deps/ab.jar": "deps/ab.jar", "old/moved.jar": "new/moved.jar", "x.js": "x.js", "deps/long/na": "deps/long/name.py", "none.txt": None, "end/": None, None: None}


def test_prefixes_of_every_length_are_tried(spark):
    other = spark.range(1, 10_051).select(F.repeat(F.lit("x"), F.col("id").cast("int")).alias("r"))
    left = spark.range(1).select(F.repeat(F.lit("y"), F.lit(10_100)).alias("l"))
    assert joins._prefixes(left, "l", other, "r").count() == 10_050


def test_every_allowed_word_protects(spark):
    vocab = spark.createDataFrame([("bad", "B", 1)], "keyword string, reason string, priority int")
    allow = spark.range(600).select(F.format_string("OK%04d", "id").alias("keyword"))
    df = spark.range(601).select("id", F.format_string("bad ok%04d", "id").alias("t"))
    assert [tuple(r) for r in labels.label(df, vocab, id="id", text=F.col("t"), allow=allow).collect()] == [(600, "B")]
    with pytest.raises(ValueError):
        labels.label(df, vocab, id="id", text=F.col("t"), allow=allow, most=599)


def _dex(*names: str) -> bytes:
    n, head = len(names), 0x70
    data, at, offsets = b"", head + 40 * n, []
    for x in names:
        offsets.append(at + len(data))
        data += bytes([len(x)]) + x.encode() + b"\0"
    b = bytearray(b"dex\n035\0".ljust(head, b"\0"))
    struct.pack_into("<4I", b, 0x38, n, head, n, head + 4 * n)
    struct.pack_into("<2I", b, 0x60, n, head + 8 * n)
    classes = b"".join(struct.pack("<8I", i, *[0] * 7) for i in range(n))
    return bytes(b) + struct.pack(f"<{n}I", *offsets) + struct.pack(f"<{n}I", *range(n)) + classes + data


def _zip(**entries: bytes) -> bytes:
    with zipfile.ZipFile(out := io.BytesIO(), "w") as z:
        for name, content in entries.items():
            z.writestr(name.replace("_", "."), content)
    return out.getvalue()


def test_dex_classes_or_an_error(spark):
    two = _zip(classes_dex=_dex("Lcom/x/Alpha;", "LBeta;"), classes2_dex=_dex("Lcom/y/Gamma;"), broken_dex=b"dex\n")
    data = [("two", two), ("none", _zip(a_txt=b"x")), ("bad", _zip(classes_dex=_dex("Lcom/x/Alpha;")[:0x78])), ("empty", _zip(classes_dex=_dex())), ("nozip", b"q"), ("null", None)]
    got = {r.path: (r.err, r.classes) for r in documents.dex_classes(spark.createDataFrame(data, "p string, c binary"), path="p", content="c").collect()}
    assert got["two"] == (None, ["Alpha", "Beta", "Gamma"]) and got["none"] == ("no-dex-entry", None)
    assert got["bad"] == got["empty"] == ("dex-parsed-nothing", None)
    assert all(got[k][0].startswith("zip:") and got[k][1] is None for k in ("nozip", "null"))


def test_a_filler_seen_once_splits_as_one_seen_often(spark):
    a, b = "https://a.example/x.m3u8", "https://b.example/y.m3u8"
    for times in (1, 3):
        df = spark.createDataFrame([(0, f"{a}|rarenote|{b}")] + [(i + 1, "rarenote") for i in range(times)], "id long, v string")
        assert [r["item"] for r in packed.split_packed(df, id="id", column="v").orderBy("pos").collect()] == [a, b]
