import datetime as dt
import random

from heddle.operators.snapshots import snapshot_changes

SCHEMA = "day string, key string, at timestamp, health string, api string, `change_kind` string, `_hash` string"


def at(h):
    return dt.datetime(2026, 1, 1, h)


def run(spark, rows):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    return sorted(map(tuple, snapshot_changes(df, date="day", key="key", order="at", compare=["health", "api"]).collect()))


def brute(rows):
    days = sorted({r[0] for r in rows if r[0] is not None})
    state = {d: {} for d in days}
    for day, key, t, health, api in rows:
        if day is None or key is None or not key.strip():
            continue
        old = state[day].get(key)
        if old is None or (t or dt.datetime.min) > old[0]:
            state[day][key] = (t or dt.datetime.min, health, api)
    out = []
    for a, b in zip(days, days[1:]):
        for k in state[a].keys() | state[b].keys():
            was, now = state[a].get(k), state[b].get(k)
            if was is None:
                out.append((b, k, "added"))
            elif now is None:
                out.append((b, k, "removed"))
            elif was[1:] != now[1:]:
                out.append((b, k, "changed"))
    return sorted(out)


def test_empty(spark):
    assert run(spark, []) == []


def test_first_snapshot_has_no_rows(spark):
    assert run(spark, [("d1", "a", at(1), "x", "y")]) == []


def test_nulls_differ_from_empty_and_blank_keys_do_not_count(spark):
    rows = [("d1", "a", at(1), None, "y"), ("d3", "a", at(1), "", "y"), ("d1", None, at(1), "x", "y"), ("d3", " ", at(1), "x", "y"), (None, "b", at(1), "x", "y")]
    assert run(spark, rows) == [("d3", "a", "changed")]


def test_values_do_not_run_into_each_other(spark):
    assert run(spark, [("d1", "a", at(1), "ab", "c"), ("d2", "a", at(1), "a", "bc")]) == [("d2", "a", "changed")]
    assert run(spark, [("d1", "a", at(1), None, "a"), ("d2", "a", at(1), "a", None)]) == [("d2", "a", "changed")]


def test_outdated_rows_and_repeats(spark):
    rows = [("d1", "a", at(2), "x", "y"), ("d1", "a", at(1), "old", "y"), ("d2", "a", at(2), "x", "y"), ("d2", "a", at(2), "x", "y"), ("d2", "a", None, "z", "y")]
    assert run(spark, rows) == []


def test_against_brute_force(spark):
    r = random.Random(5)
    rows = {}
    for _ in range(600):
        k = (r.choice(["d1", "d2", "d4", None]), r.choice(["hot", "hot", *map(str, range(40)), None, ""]), at(r.randrange(23)))
        rows[k] = (*k, r.choice(["x", None, ""]), r.choice(["y" * 5000, None]))
    rows = list(rows.values())
    want = brute(rows)
    assert run(spark, rows) == want and run(spark, rows[::-1]) == want
