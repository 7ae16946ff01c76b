import random

from heddle.llm.leaks import Blocks, leaked_passages, normal, places

ITEM = "Of 8619 catalogs sent by Keprenox, only 6099 refer to Tomarri while 9898 refer to Urdholfe. How much is left?"


def brute(doc, item, run):
    d, t = normal(doc or ""), normal(item or "")
    return any(d[i : i + run] in t for i in range(len(d) - run + 1))


def test_runs_against_brute_force():
    r = random.Random(6)
    for _ in range(200):
        items = [(i, "".join(r.choice("ab") for _ in range(r.randrange(5, 40)))) for i in range(4)]
        doc = "".join(r.choice("ab ") for _ in range(80))
        b = Blocks(items, 9)
        got = {b.items[k][0] for k, _, _ in b.runs(normal(doc))}
        assert got == {i for i, t in items if brute(doc, t, 9)}


def test_spans_map_to_the_original(spark):
    part = ITEM[20:90]
    text = "Intro.\n> " + part.upper().replace(" ", "\n  >") + " || end İ"
    docs = spark.createDataFrame([(1, text), (2, None), (3, ""), (4, "short"), (5, ITEM[:50]), (None, ITEM), (7, "x " * 60_000 + ITEM), (7, ITEM)], "id long, text string")
    items = spark.createDataFrame([(1, ITEM), (2, ITEM), (3, None), (4, "tiny"), (5, "")], "i long, t string")
    for slices in (20_000_000, 100):
        got = leaked_passages(docs, items, id="id", text="text", item_id="i", item_text="t", slice_chars=slices).collect()
        assert {(r.id, r.item_id) for r in got} == {(i, k) for i in (1, None, 7) for k in (1, 2)} and len(got) == 8
        r = next(r for r in got if r.id == 1)
        assert normal(text[r.start : r.end]) in normal(ITEM) and len(normal(text[r.start : r.end])) >= 50
    assert leaked_passages(docs, items.limit(0), id="id", text="text", item_id="i", item_text="t").count() == 0


def test_exactly_fifty():
    n = normal(ITEM)
    b = Blocks([(1, ITEM)], 50)
    assert b.runs("z" + n[7:57] + "z") == [(0, 1, 51)] and b.runs("z" + n[7:56] + "z") == []


def test_places():
    for t in ("aB-c İx", "ß, é", "  鹿 雨"):
        assert [t[i].lower()[0] for i in places(t)] == [c for c in normal(t)]
