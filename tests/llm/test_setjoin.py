import random

import pytest

from heddle.llm.setjoin import set_classes, similar_classes, similar_counts, similar_pairs

SCHEMA = "id long, kind int, names array<string>, cls string, size int"


def clean(names):
    return frozenset(x.strip().lower() for x in names or [] if x is not None and x.strip())


def brute(rows, t=(7, 10), least=1):
    s = [(i, k, clean(n)) for i, k, n in rows if i is not None and k is not None and n is not None and len(clean(n)) >= least]
    out = set()
    for x in range(len(s)):
        for y in range(x):
            (i, k, a), (j, m, b) = s[x], s[y]
            if k == m and i != j and len(a & b) * t[1] >= t[0] * len(a | b):
                out.add((min(i, j), max(i, j)))
    return sorted(out)


def run(spark, rows, most=100, least=1):
    df = spark.createDataFrame([(*r, "c", 1) for r in rows], SCHEMA)
    return sorted(map(tuple, similar_pairs(df, id="id", type="kind", values="names", threshold=0.7, least=least, most=most).collect()))


def test_edges(spark):
    assert run(spark, []) == []
    rows = [(1, 1, ["A", " b "]), (2, 1, ["b", "a", "a", None, " "]), (3, 2, ["a", "b"]), (4, None, ["a", "b"]), (None, 1, ["a", "b"]), (5, 1, None), (6, 1, []), (7, 1, [None, ""])]
    assert run(spark, rows) == [(1, 2)]
    assert run(spark, rows, least=3) == []


def test_exactly_the_threshold(spark):
    a = [f"t{i}" for i in range(10)]
    assert run(spark, [(1, 1, a), (2, 1, a[:7]), (3, 1, a[:6])]) == [(1, 2), (2, 3)]


def test_same_id_twice_is_not_a_pair(spark):
    assert run(spark, [(1, 1, ["a", "b", "c", "d"]), (1, 1, ["a", "b", "c", "d"]), (1, 1, ["a", "b", "c", "d", "e"])]) == []


@pytest.mark.parametrize("most", [1, 3, 100])
def test_against_brute_force(spark, most):
    r = random.Random(7)
    base = [[f"w{min(int(r.paretovariate(0.7)), 60)}" for _ in range(r.choice([3, 5, 8, 20]))] for _ in range(25)]
    rows = []
    for i in range(160):
        names = list(r.choice(base))
        for _ in range(r.randrange(3)):
            names[r.randrange(len(names))] = f"w{r.randrange(80)}"
        rows.append((i, r.choice([1, 1, 2]), [x.upper() if r.random() < 0.2 else x for x in names]))
    rows += [(500 + i, 1, ["hot", *[f"z{j}" for j in range(6)], f"own{i}"]) for i in range(12)]
    assert run(spark, rows, most) == brute(rows)


def test_long_arrays_and_counts(spark):
    long = [f"n{i}" for i in range(20_000)]
    rows = [(1, 1, long), (2, 1, long[:15_000]), (3, 1, long), (4, 1, ["x"])]
    df = spark.createDataFrame([(*r, "c", 1) for r in rows], SCHEMA)
    assert run(spark, rows) == [(1, 2), (1, 3), (2, 3)]
    got = sorted(map(tuple, similar_counts(df, id="id", type="kind", values="names", threshold=0.7).collect()))
    assert got == [(1, 1, 2), (2, 2, 2), (3, 1, 2), (4, 4, 0)]


def test_longer_prefixes_give_fewer_candidates_and_the_same_pairs(spark):
    rows = [(i, 1, ["h1", "h2", "h3", f"u{i % 9}", f"v{i}"]) for i in range(60)]
    df = spark.createDataFrame([(*r, "c", 1) for r in rows], SCHEMA)
    _, classes = set_classes(df, id="id", type="kind", values="names", least=1)
    one = {tuple(r) for r in similar_classes(classes, 0.6, most=1000).collect()}
    two = {tuple(r) for r in similar_classes(classes, 0.6, most=2).collect()}
    assert one == two and one
