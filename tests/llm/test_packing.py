import random

import numpy as np
import pytest

from heddle.llm.packing import pack, sum_of_squares, token_counter, token_sizes


def brute(sizes, capacity):
    """Sum of squares, straight from its definition."""
    bins, out = [], []
    for s in sizes:
        best = None
        gaps = {g for g in bins if 0 < g < capacity and g >= s} | {capacity}
        for g in sorted(gaps):
            after = list(bins)
            if g == capacity:
                after.append(g - s)
            else:
                after[after.index(g)] -= s
            count = {}
            for x in after:
                if 0 < x < capacity:
                    count[x] = count.get(x, 0) + 1
            score = sum(n * n for n in count.values())
            if best is None or score < best[0] or (score == best[0] and best[1] == capacity):
                best = (score, g)
            if g == capacity and score < best[0]:
                best = (score, g)
        g = best[1]
        if g == capacity:
            bins.append(capacity - s)
            out.append(len(bins) - 1)
        else:
            i = max(i for i, x in enumerate(bins) if x == g)
            bins[i] -= s
            out.append(i)
    return bins


def test_sum_of_squares_against_its_definition():
    r = random.Random(2)
    for cap in (5, 10, 37):
        for _ in range(6):
            sizes = [r.randint(1, cap) for _ in range(60)]
            box = sum_of_squares(np.array(sizes), cap)
            gaps = [cap - sum(s for s, b in zip(sizes, box) if b == k) for k in range(box.max() + 1)]
            assert min(gaps) >= 0 and sorted(gaps) == sorted(brute(sizes, cap))


def check(rows, sizes, capacity):
    fill, got = {}, {}
    for i, part, start, size, box in rows:
        assert 0 < size <= capacity and start == part * capacity
        fill[box] = fill.get(box, 0) + size
        got.setdefault(i, []).append((part, size))
    assert max(fill.values(), default=0) <= capacity
    want = {}
    for i, s in sizes:
        if s and s > 0:
            want[i] = want.get(i, 0) + s
            if s <= capacity:
                assert len(got[i]) == 1
    assert {i: sum(s for _, s in p) for i, p in got.items()} == want
    return fill


def test_pack(spark):
    r = random.Random(3)
    sizes = [(i, r.choice([1, 3, 7, 50, 99, 100, 101, 250, 400, 0, -2, None])) for i in range(500)] + [(None, 42), (1 << 60, 7)]
    df = spark.createDataFrame([(*s, "x", 0) for s in sizes], "id long, size long, task string, part int")
    fill = check(list(map(tuple, pack(df, 100).collect())), sizes, 100)
    assert len(fill) <= sum(s for _, s in sizes if s and s > 0) / 100 * 1.05 + 2
    many = check(list(map(tuple, pack(df, 100, items_per_task=100).collect())), sizes, 100)
    assert len(many) < len(fill) + 8 * 3
    assert pack(df.limit(0), 100).count() == 0


@pytest.mark.parametrize("name", ["byte_bpe_multi_50k.tiktoken", "byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_counters(name):
    texts = ["", "Hello world", "鹿雨 <|endoftext|> x" * 50]
    got = token_counter(name, "/opt/tokenizers")(texts)
    assert got[0] == 0 and got[1] >= 2 and got[2] > 100


def test_sizes(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None), (3, ""), (None, "a b")], "id long, text string")
    got = {r.id: r.size for r in token_sizes(df, id="id", text="text").collect()}
    assert got == {1: 2, 3: 0, None: 2}


@pytest.mark.parametrize("name", ["byte_bpe_multi_50k.tiktoken", "byte_bpe_50k.json", "piece_bpe_32k.model", "word_bpe_49k.json"])
def test_pieces_are_places_in_the_text(spark, name):
    """The pieces' bytes are the text again, each of at most the capacity's tokens, whatever signs it has."""
    texts = {1: "short", 2: "鹿雨 🎬 naïve Ångström <|endoftext|> word " * 40, 3: "x" * 3000, 4: "", 5: "🏮" * 300, 6: "a b " * 8}
    df = spark.createDataFrame([*texts.items(), (7, None)], "id long, text string")
    sizes = token_sizes(df, id="id", text="text", capacity=16, tokenizer=name)
    rows = sorted(map(tuple, pack(sizes, 16).collect()))
    got = {}
    for i, part, _, size, _, a, b in rows:
        assert part == len(got.setdefault(i, [])) and 0 < size <= 16
        got[i].append(texts[i].encode()[a:b])
    assert {i: b"".join(x).decode() for i, x in got.items()} == {i: t for i, t in texts.items() if t}
    assert all(len(got[i]) > 1 for i in (2, 5)) and len(got[1]) == 1


def test_places_stay_with_their_items(spark):
    rows = [(i, s, 7 * s, [7 * k for k in range(10, s, 10)] if s > 10 else None) for i, s in enumerate([35, 10, 3, 11, 100, 1])]
    df = spark.createDataFrame(rows, "id long, size long, bytes long, cuts array<long>")
    assert sorted((r.id, r.from_byte, r.to_byte) for r in pack(df, 10).collect()) == sorted((i, 7 * k, 7 * min(k + 10, s)) for i, s, _, _ in rows for k in range(0, s, 10))
