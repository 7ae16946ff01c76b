import random

import numpy as np
import pytest

from heddle.llm.components import link_groups
from heddle.operators.union_find import union_find

SCHEMA = "a string, b string, v string, up int"


def brute(rows):
    up = {}

    def find(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in rows:
        if a is not None and b is not None and a != b:
            x, y = sorted((find(a), find(b)))
            up[y] = x
    return sorted((x, find(x)) for x in up)


def run(spark, rows, most=1_000_000, parts=3):
    df = spark.createDataFrame([(*r, "z", 1) for r in rows], SCHEMA).repartition(parts)
    return sorted(map(tuple, link_groups(df, a="a", b="b", most=most).collect()))


def test_union_find():
    r = random.Random(1)
    for n, m in ((1, 0), (2, 1), (50, 30), (200, 180), (300, 900)):
        e = [(r.randrange(n), r.randrange(n)) for _ in range(m)]
        got = union_find(np.array([x for x, _ in e], dtype=int), np.array([y for _, y in e], dtype=int), n)
        want = dict(brute([(f"{x:04}", f"{y:04}") for x, y in e]))
        assert got.tolist() == [int(want.get(f"{i:04}", i)) for i in range(n)]


def test_empty_nulls_loops_and_repeats(spark):
    assert run(spark, []) == []
    assert run(spark, [(None, "a"), ("a", None), ("b", "b")]) == []
    assert run(spark, [("b", "a"), ("a", "b"), ("b", "a"), ("", "c"), ("x" * 10_000, "y")]) == sorted([("a", "a"), ("b", "a"), ("", ""), ("c", ""), ("x" * 10_000, "x" * 10_000), ("y", "x" * 10_000)])


@pytest.mark.parametrize("most", [3, 1_000_000])
def test_long_chain_and_hub(spark, most):
    n = 60
    chain = [(f"c{i:04}", f"c{i + 1:04}") for i in range(n)]
    hub = [(f"h{i:04}", "hub") for i in range(n)]
    rows = chain + hub
    random.Random(2).shuffle(rows)
    assert run(spark, rows, most) == brute(rows)


def test_random_graphs_any_piece_size(spark):
    r = random.Random(3)
    rows = [(f"k{r.randrange(150)}", f"k{r.randrange(150)}") for _ in range(110)] + [(None, "k1"), ("q", "q")]
    want = brute(rows)
    assert run(spark, rows, 7, 2) == want and run(spark, rows, 40, 5) == want and run(spark, rows) == want
