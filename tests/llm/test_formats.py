import random
import re

from heddle.llm import formats
from heddle.llm.formats import address_form, collapse_formats, encode, format_copies, plain_form

SCHEMA = "id long, k string, n string, api string, tuple string, code long, uses int"
FIELDS = {"k": plain_form, "n": plain_form, "api": address_form}


def canon(r):
    plain = lambda x: re.sub(r"[\W_]+", "", x or "").lower()
    base, _, q = (r[3] or "").partition("?")
    return plain(r[1]), plain(r[2]), plain(base), tuple(sorted(filter(None, map(plain, q.split("&")))))


def brute(rows):
    g = {}
    for r in rows:
        if r[0] is not None:
            g.setdefault(canon(r), set()).add(r[0])
    return sorted((min(v), x) for v in g.values() for x in v if x != min(v))


def make(spark, rows):
    return spark.createDataFrame([(*r, "t", 1, 2) for r in rows], SCHEMA)


def run(spark, rows):
    return sorted(map(tuple, format_copies(make(spark, rows), id="id", fields=FIELDS).collect()))


CASES = [
    (1, "a-b", "Name x", "http://h/p?a=1&b=2"),
    (2, "A.B", "[name] X", "HTTP://h/p/?b=2&a=1&"),
    (3, "a-b", "Name x", "http://h/p?a=1"),
    (4, None, None, None),
    (5, "", " - ", "?&&"),
    (6, "a-b", "Name x", "http://h/pa1?b=2"),
    (None, "a-b", "Name x", None),
    (7, "鹿.山", "ΧΟΡΌΣ", "x"),
    (8, "鹿山", "χορός", "X"),
    (9, "ab", "name" + " " * 100_000 + "x", "httphp?b2&a1"),
]


def test_cases(spark):
    assert run(spark, CASES) == brute(CASES) == [(1, 2), (1, 9), (4, 5), (7, 8)]
    assert run(spark, []) == []


def test_repeated_rows_and_ids(spark):
    rows = [(1, "a", "b", "c"), (1, "a", "b", "c"), (2, "A", "b", "c"), (2, "z", "b", "c")]
    assert run(spark, rows) == [(1, 2)]
    assert sorted(map(tuple, collapse_formats(make(spark, rows), id="id", fields=FIELDS).collect())) == [(1, 2), (2, 1)]


def test_against_brute_force(spark):
    r = random.Random(4)
    rows = [(i, r.choice(["hot", "H-ot", "x", "y ", None]), r.choice(["n", "N!", "m", ""]), r.choice(["u?b=1&a=2", "U?a=2&b=1", "u?a=2", None])) for i in range(300)]
    assert run(spark, rows) == brute(rows)


def test_tuples_are_sorted_and_compact(spark):
    got = encode(make(spark, CASES[:5]), id="id", fields=FIELDS).collect()
    by = {r.id: [(p.field, p.code) for p in r.tuple] for r in got}
    assert by[4] == by[5] == [] and [f for f, _ in by[1]] == [0, 1, 2] and by[1] == by[2]


def test_codes_that_clash_are_told_apart(spark, monkeypatch):
    real = formats.F.xxhash64
    clash = lambda *a: formats.F.lit(5).cast("long") if a and isinstance(a[0], str) and a[0] == "field" else real(*a)
    monkeypatch.setattr(formats.F, "xxhash64", clash)
    d = formats.build_dictionary(make(spark, [(1, "a", "n", "x"), (2, "b", "n", "x")]), {"k": plain_form})
    codes = {r.raw: r.code for r in d.collect()}
    assert codes["a"] != codes["b"]
