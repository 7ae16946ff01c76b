import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from heddle.operators.packed import Dictionary, _Known, cover, known_values, mask_tail, segment, split_packed

TAILS = ["|User-Agent=v", ";v=v?k=v|b", ",0,0", "#line0", ";md0;h"]
FILLERS = ["n/a", "待更新"]


@pytest.fixture(scope="module")
def known():
    return _Known(Dictionary(TAILS, FILLERS))


A, B, C = "http://a.example/x.m3u8?ids=1,22,3", "rtsp://b.test/l;v=3?k=a|b", "../jar/q.jar;md5;0123456789abcdef0123456789abcdef"
D, E = "https://c.test/p#line4", "./ext/z.json"
U = "http://d.test/?u=http://in.example/y|User-Agent=okhttp/3.1"


@pytest.mark.parametrize("sep", [",", "，", "、", ";", "；", "|", "｜", "#", "$$$", "\t", "\n", "\r\n", " ", "  ", " | ", " ; ", " ， ", ",,", "$$$$$$"])
def test_separators_and_suffixes(known, sep):
    want = [A, B, C, D, E, U, A]
    assert segment(sep.join(want), known) == want
    assert segment(sep + sep.join(want) + sep, known) == want


@pytest.mark.parametrize("q", ['"', "'"])
@pytest.mark.parametrize("sep", [",", ";", " ", "#", "|", ", "])
def test_quotes(known, q, sep):
    assert segment(sep.join(q + x + q for x in (A, B, E, U)), known) == [A, B, E, U]
    assert segment(A + sep + q + B + q, known) == [A, B]


def test_json(known):
    want = [A, B, C, U]
    assert segment(json.dumps(want), known) == want
    assert segment(json.dumps(want).replace("/", "\\/"), known) == want
    assert segment(json.dumps({"u": A, "v": B}), known) == [json.dumps({"u": A, "v": B})]
    assert segment(json.dumps([A, 3, None, "n/a", B]), known) == [A, B]
    assert segment("[" + A + "," + B, known) == [A, B]


def test_filler_is_dropped_and_tails_kept(known):
    assert segment(f"{A},n/a,{B},待更新", known) == [A, B]
    assert segment(f"{A} backup {B}", known) == [A, B]
    assert segment(f"{A},rare note,{B}", _Known(Dictionary([], ["rare note"]))) == [A, B]
    assert cover([8, 2, 4, 8], [True, False, False, True], [False, True, False, False], [False] * 4, {2: [(3, "filler")]}) == [(0, 2), (3, 4)]
    assert cover([8, 8, 8], [True] * 3, [False] * 3, [False] * 3, {0: [(2, "whole")]}) == [(0, 2), (2, 3)]


def test_none_and_blank(known):
    for v in (None, "", "  ", "not-a-url", ",,,", "$$$"):
        assert segment(v, known) == []


def test_mask():
    assert mask_tail(";md5;0123456789abcdef0123456789abcdef") == ";md0;h"
    assert mask_tail("|User-Agent=okhttp/3.12") == "|User-Agent=v"


def test_operator(spark):
    rows = [(1, f"{A},{B}"), (2, A), (3, None), (4, ""), (4, f"{E}$$$$$${E}"), (None, f"{A}\n{D}"), (6, "n/a"), (7, "n/a"), (8, ",".join([A] * 3000))]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "id long, v string, item string, pos int")
    assert known_values(df, "v").fillers == ["n/a"] and known_values(df, "v").table is None
    got = split_packed(df, id="id", column="v").collect()
    by = {}
    for r in got:
        by.setdefault(r.rec_id, []).append((r.pos, r["item"]))
    assert by[1] == [(1, A), (2, B)] and by[4] == [(1, E), (2, E)] and by[None] == [(1, A), (2, D)]
    assert len(by[8]) == 3000 and set(by) == {1, 4, None, 8}
    assert split_packed(df.limit(0), id="id", column="v").count() == 0


HEADS = ["http://a.example/x", "https://b.test/y.m3u8", "rtmp://c.invalid/z", "./js/q.js", "../jar/w.jar"]
ENDS = ["", "?ids=1,22,3", "?a=1&b=x", ";v=3?k=a|b", "|User-Agent=okhttp/3.12", "#line7", ";md5;0123456789abcdef0123456789abcdef", "?u=http://in.example/x"]
SEPS = [",", "，", "、", ";", "；", "|", "｜", "#", "$$$", "\t", "\n", "\r\n", " ", "  ", " , ", " # ", ",,", "$$$$$$", "##"]


@settings(max_examples=300, deadline=None)
@given(
    st.lists(st.tuples(st.sampled_from(HEADS), st.sampled_from(ENDS)).map("".join), min_size=1, max_size=9),
    st.sampled_from(SEPS),
    st.sampled_from(["", '"', "'"]),
    st.booleans(),
)
def test_round_trip(items, sep, quote, edges):
    """Whatever is packed comes out again, in order and whole, with the dictionary and without."""
    text = sep.join(quote + x + quote for x in items)
    if edges:
        text = sep + text + sep
    assert segment(text, _Known(Dictionary(TAILS, FILLERS))) == items == segment(text, _Known(Dictionary()))
    assert segment(json.dumps(items), _Known(Dictionary(TAILS, FILLERS))) == items


NESTED = "http://p.example/?list=http://c.example/1,http://d.example/2;http://b.example/3"


def test_heads_and_delimiters_inside_a_known_value_are_protected():
    d = _Known(Dictionary(TAILS, FILLERS, [NESTED]))
    for sep in (",", ";", " ", "|", "#", "$$$"):
        assert segment(sep.join([A, NESTED, B]), d) == [A, NESTED, B]
        assert segment(sep.join([NESTED, NESTED]), d) == [NESTED, NESTED]
    assert segment(NESTED + "|User-Agent=x," + A, d) == [NESTED + "|User-Agent=x", A]
    assert len(segment(NESTED, _Known(Dictionary()))) == 3
    assert segment(NESTED + "4," + A, d) == [*segment(NESTED + "4", _Known(Dictionary())), A]  # a longer value is another one


def items(df, **more):
    got = {}
    for r in split_packed(df, id="id", column="v", **more).orderBy("rec_id", "pos").collect():
        got.setdefault(r.rec_id, []).append(r["item"])
    return got


def test_whole_values_come_from_lists_quotes_and_single_columns(spark):
    rows = [(1, f"{NESTED},{A}"), (2, json.dumps([NESTED, B])), (3, f"{A};{NESTED}|x")]
    df = spark.createDataFrame(rows, "id long, v string")
    assert items(df)[1] == [NESTED, A]
    assert items(df.where("id <> 2").unionByName(spark.createDataFrame([(2, f'"{NESTED}" "{A}"')], df.schema)))[1] == [NESTED, A]
    lone = df.where("id = 1")
    assert items(lone)[1] == ["http://p.example/?list=http://c.example/1", "http://d.example/2", "http://b.example/3", A]
    known = known_values(lone, "v", single=[spark.createDataFrame([(NESTED,), (A,), (None,)], "api string")])
    assert items(lone, known=known) == {1: [NESTED, A]}


def test_rare_and_long_entries_count(spark):
    """A tail seen once, tails of any length, and entries beyond the lists are used like all others."""
    long = "|Note=a b " + "x-" * 150
    rows = [(i, f"https://h{i}.example/m|t{i}x=v,n{i}") for i in range(30)]
    rows += [(100, "https://q.example/x|Referer=q r"), (101, f"{A} | {B}|Referer=q r,{A}"), (102, "https://q.example/x" + long), (103, f"{B}{long},{A}"), (104, "some words"), (105, f"{A},some words,{B}"), (106, json.dumps([NESTED, A])), (107, f"{B} {NESTED} {A}"), (None, f"{A},some words,{B}")]
    rows += [(200 + i, f"{A},some words,{B}") for i in range(40)]
    df = spark.createDataFrame(rows, "id long, v string")
    whole = items(df)
    assert whole[101] == [A, B + "|Referer=q r", A] and whole[103] == [B + long.rstrip(), A]
    assert whole[105] == whole[None] == whole[230] == [A, B] and whole[107] == [B, NESTED, A]
    small = known_values(df, "v", most=1)
    assert small.table is not None and len(small.tails) == len(small.fillers) == 1
    assert items(df, known=small) == whole
