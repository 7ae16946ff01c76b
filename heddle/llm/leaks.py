"""Passages of evaluation texts inside a training corpus.

Texts are reduced to their letters and digits in lower case. A shared run of at least ``run`` of them must contain one of
the blocks of ``run // 2`` that an item is cut into at a fixed step, so one Aho-Corasick automaton over those blocks finds
every candidate in a single scan of the text. Each hit is then stretched to the whole shared run, whose ends are mapped
back to places in the original text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heddle.runtime import durable

_DROPPED = re.compile(r"[\W_]+")
_BUILT: dict[tuple[int, int], tuple] = {}


def normal(text: str) -> str:
    """Letters and digits only, in lower case."""
    return _DROPPED.sub("", text.lower())


def places(text: str) -> list[int]:
    """For each character of the normal form, its place in the original."""
    if len(text.lower()) == len(text):
        return [i for i, c in enumerate(text.lower()) if c.isalnum()]
    return [i for i, c in enumerate(text) for x in c.lower() if x.isalnum()]


class Blocks:
    """The automaton over the blocks of items, and the items' normal forms."""

    def __init__(self, items: list[tuple[int, str]], run: int):
        import ahocorasick

        self.size, self.step, self.run = run // 2, run - run // 2 + 1, run
        self.items = [(i, n) for i, t in items if len(n := normal(t)) >= run]
        where: dict[str, list[tuple[int, int]]] = {}
        for k, (_, n) in enumerate(self.items):
            for at in range(0, len(n) - self.size + 1, self.step):
                where.setdefault(n[at : at + self.size], []).append((k, at))
        self.auto = ahocorasick.Automaton()
        for block, at in where.items():
            self.auto.add_word(block, at)
        if where:
            self.auto.make_automaton()

    def runs(self, doc: str) -> list[tuple[int, int, int]]:
        """(item, start, end) of the maximal shared runs in a normal text; an item by its place in ``items``."""
        if not len(self.auto) or len(doc) < self.run:
            return []
        found, reached = [], {}
        for end, hits in self.auto.iter(doc):
            at = end - self.size + 1
            for k, pos in hits:
                if reached.get((k, at - pos), -1) >= end:
                    continue  # inside a run that is known already
                item = self.items[k][1]
                a, b = at, pos
                while a and b and doc[a - 1] == item[b - 1]:
                    a, b = a - 1, b - 1
                y, z = end + 1, pos + self.size
                while y < len(doc) and z < len(item) and doc[y] == item[z]:
                    y, z = y + 1, z + 1
                reached[(k, at - pos)] = y - 1
                if y - a >= self.run:
                    found.append((k, a, y))
        return found


def _blocks(shared: object, run: int) -> Blocks:
    """The automaton of a broadcast list of items, built once a Python worker."""
    key = (id(shared.value), run)
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = (shared.value, Blocks(shared.value, run))
    return _BUILT[key][1]


def leaked_passages(docs: DataFrame, items: DataFrame, *, id: str, text: str, item_id: str, item_text: str, run: int = 50, slice_chars: int = 20_000_000) -> DataFrame:
    """(id, item_id, start, end) for every run of at least ``run`` letters and digits that a text shares with an item.

    Everything else is dropped and case is ignored before comparing; start and end are places in the original text.

    - Null texts share nothing, nor do texts and items with fewer than ``run`` letters and digits.
    - Items with the same text are all reported; a run that occurs twice is reported twice. Null ids are kept as null.
    - Texts of any length are scanned whole. Repeated rows come out each time. Empty tables give no rows.
    - Further columns are not read, whatever their names.

    A map over the scan of the texts. The items go to the executors. If they have more than ``slice_chars`` characters they go
    in slices of about that size, one after the other, each with a scan of its own whose hits are written: driver and workers
    hold one slice at a time, however many items there are.
    """
    spark = docs.sparkSession
    tests = items.select(F.col(item_id).cast("long").alias("i"), F.col(item_text).alias("t")).where(F.length("t") >= run)
    size = tests.agg(F.coalesce(F.sum(F.length("t")), F.lit(0))).first()[0]
    slices = max(1, -(-int(size) // slice_chars))
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text")).where(F.length("text") >= run)
    kind = dict(rows.dtypes)["id"]
    out = None
    for k in range(slices):
        some = tests.where(F.pmod(F.xxhash64("t"), F.lit(slices)) == k) if slices > 1 else tests
        shared = spark.sparkContext.broadcast([(r.i, r.t) for r in some.collect()])
        hits = rows.mapInArrow(_scan(shared, run), f"id {kind}, item_id long, start int, end int")
        if slices > 1:
            hits = durable(hits)
            shared.destroy()
        out = hits if out is None else out.unionByName(hits)
    return out


def _scan(shared: object, run: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = _blocks(shared, run)
        for b in batches:
            row, item, start, end = [], [], [], []
            for i, t in enumerate(b.column("text").to_pylist()):
                found = blocks.runs(normal(t))
                if found:
                    at = places(t)
                    for k, a, y in found:
                        row.append(i)
                        item.append(blocks.items[k][0])
                        start.append(at[a])
                        end.append(at[y - 1] + 1)
            made = [b.column("id").take(pa.array(row, pa.int64())), pa.array(item, pa.int64()), pa.array(start, pa.int32()), pa.array(end, pa.int32())]
            yield pa.RecordBatch.from_arrays(made, names=["id", "item_id", "start", "end"])

    return scan
