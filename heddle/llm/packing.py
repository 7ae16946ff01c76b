"""Filling containers of fixed capacity with documents, measured in tokens of a public tokenizer.

Sum-of-squares packing: each document goes where the sum over gaps of (open containers with that gap) squared becomes
smallest, which keeps gaps of all sizes in stock. Documents over the capacity, and only they, are split. Tokens are counted
once; the packing itself moves numbers, not texts. Tasks pack disjoint shares of the documents, each large enough that the
containers it leaves open at its end don't matter.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heddle.runtime import durable

TOKENIZERS = "/opt/tokenizers"
#: Fixed value: the pattern by which byte-level BPE cuts a text into words.
BYTE_BPE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Tokenizer:
    """A vocabulary file: encodings of texts, how many tokens an encoding has, and where in the UTF-8 bytes of its text each
    token begins (it may begin inside a character)."""

    def __init__(self, path: str):
        self.encode: Callable[[list[str]], list]
        self.size: Callable[[object], int] = len
        self.starts: Callable[[str, object], list[int]]
        if path.endswith(".tiktoken"):
            import tiktoken

            with open(path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            enc = tiktoken.Encoding("own", pat_str=BYTE_BPE_PATTERN, mergeable_ranks=ranks, special_tokens={})
            width = {v: len(k) for k, v in ranks.items()}
            self.encode = lambda texts: [enc.encode_ordinary(t) for t in texts]
            self.starts = lambda text, e: [0, *accumulate(width[x] for x in e)][:-1]
        elif path.endswith(".model"):
            import sentencepiece

            sp = sentencepiece.SentencePieceProcessor(model_file=path)
            self.encode = lambda texts: sp.encode(texts, num_threads=1) if texts else []
            self.starts = lambda text, e: _in_bytes(text, [a for a, _ in sp.encode(text, out_type="offset_mapping")["offsets"]])
        else:
            import os

            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer as Own

            tok = Own.from_file(path)
            tok.encode_special_tokens = True
            self.encode = lambda texts: tok.encode_batch(texts, add_special_tokens=False) if texts else []
            self.size = lambda e: len(e.ids)
            self.starts = lambda text, e: _in_bytes(text, [a for a, _ in e.offsets])


def _in_bytes(text: str, places: list[int]) -> list[int]:
    at = [0, *accumulate(len(c.encode("utf-8", "surrogatepass")) for c in text)]
    return [at[i] for i in places]


@lru_cache(maxsize=4)
def tokenizer_of(name: str, folder: str) -> Tokenizer:
    """The tokenizer in the vocabulary file ``name`` of ``folder``; one is held by each Python worker."""
    return Tokenizer(f"{folder}/{name}")


def token_counter(name: str, folder: str) -> Callable[[list[str]], list[int]]:
    """Counts the tokens of texts."""
    tok = tokenizer_of(name, folder)
    return lambda texts: [tok.size(e) for e in tok.encode(texts)]


def token_sizes(df: DataFrame, *, id: str, text: str, capacity: int | None = None, tokenizer: str = "byte_bpe_multi_50k.tiktoken", folder: str = TOKENIZERS) -> DataFrame:
    """(id, size): the tokens of each text, whole; null texts are left out.

    With ``capacity`` also (bytes, cuts): the bytes of the text, and for a text of more tokens than that the bytes before its
    second and further pieces, so that nobody needs to tokenise again to cut it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer_of(tokenizer, folder)
        for b in batches:
            texts = b.column("text").to_pylist()
            sizes: list[int] = []
            cuts: list[list[int] | None] = []
            for some in (texts[i : i + 64] for i in range(0, len(texts), 64)):  # few encodings are held at a time
                for t, e in zip(some, tok.encode(some)):
                    sizes.append(tok.size(e))
                    cuts.append(tok.starts(t, e)[capacity::capacity] if capacity is not None and sizes[-1] > capacity else None)
            made = [b.column("id"), pa.array(sizes, type=pa.int64())]
            if capacity is not None:
                made += [b.column("bytes"), pa.array(cuts, type=pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(made, names=["id", "size", "bytes", "cuts"][: len(made)])

    kind = dict(df.dtypes)[id]
    rows = df.select(F.col(id).alias("id"), F.col(text).alias("text"), F.octet_length(text).cast("long").alias("bytes")).where(F.col("text").isNotNull())
    return rows.mapInArrow(run, f"id {kind}, size long" + (", bytes long, cuts array<long>" if capacity is not None else ""))


def sum_of_squares(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The container of each item, placed in the given order; sizes are 1..capacity."""
    n = np.zeros(capacity + 1, dtype=np.int64)  # open containers by gap
    stock: list[list[int]] = [[] for _ in range(capacity + 1)]
    out = np.empty(len(sizes), dtype=np.int64)
    opened = 0
    far = np.iinfo(np.int64).max
    for i, s in enumerate(sizes.tolist()):
        if s == capacity:
            out[i], opened = opened, opened + 1
            continue
        # Halved change of the sum of squares: gap g loses one container, gap g - s gains one; gap 0 is closed and counts 0.
        after = n[: capacity - s + 1]
        delta = np.where(n[s:] > 0, 2 * (after - n[s:]) + 2, far)
        delta[0] = 1 - 2 * n[s] if n[s] else far
        new = 2 * n[capacity - s] + 1
        g = int(delta[:-1].argmin()) if capacity > s else 0
        if delta[g] <= new and delta[g] != far:
            gap = g + s
            box = stock[gap].pop()
            n[gap] -= 1
        else:
            gap, box, opened = capacity, opened, opened + 1
        out[i] = box
        if gap > s:
            stock[gap - s].append(box)
            n[gap - s] += 1
    return out


def pack(sizes: DataFrame, capacity: int, *, containers_per_task: int = 10_000, items_per_task: int = 400_000) -> DataFrame:
    """(id, part, start, size, container): the pieces of each item with the container they are in.

    An item of at most ``capacity`` is one piece, part 0. A larger one is cut every ``capacity`` units; its full pieces are
    containers of their own and its rest is packed like any item. ``start`` is the piece's place in its item.

    If ``sizes`` has bytes and cuts for this capacity, pieces also have (from_byte, to_byte), their place in the text; the
    pieces of a text cover it without gaps.

    - Items of null, zero or negative size hold nothing and have no row; a null id is kept as null.
    - Repeated rows are separate items. Equal sizes keep no fixed order. An empty table gives no rows.
    - Further columns are not read. ``container`` is unique over all tasks.
    """
    placed = {"bytes", "cuts"} <= set(sizes.columns)
    rows = durable(sizes.select("id", F.col("size").cast("long").alias("size"), *(["bytes", "cuts"] if placed else [])).where("size > 0"))
    total, n = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
    tasks = max(1, -(-int(total) // (capacity * containers_per_task)), -(-n // items_per_task))
    # The row number of a written table is the same when a task is run again.
    rows = rows.withColumn("task", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(tasks)).cast("int"))

    def run(key: tuple, items: pa.Table) -> pa.Table:
        size = items["size"].to_numpy()
        full, rest = size // capacity, size % capacity
        pieces = full + (rest > 0)
        at = np.repeat(np.arange(len(size)), pieces)
        part = np.arange(len(at)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        length = np.minimum(capacity, size[at] - part * capacity)
        order = np.argsort(-length, kind="stable")  # largest first: small documents fill what the large ones leave
        box = np.empty(len(at), dtype=np.int64)
        box[order] = sum_of_squares(length[order], capacity)
        made = [items["id"].combine_chunks().take(pa.array(at)), pa.array(part, pa.int32()), pa.array(part * capacity), pa.array(length), pa.array((key[0].as_py() << 32) + box)]
        if placed:
            ends = np.cumsum(pieces)
            first, last = np.zeros(len(at), dtype=np.int64), items["bytes"].to_numpy()[at]
            cuts = items["cuts"].combine_chunks()
            for i in np.flatnonzero(pieces > 1).tolist():
                to, inner = ends[i], cuts[i].values.to_numpy()
                first[to - pieces[i] + 1 : to] = inner
                last[to - pieces[i] : to - 1] = inner
            made += [pa.array(first), pa.array(last)]
        return pa.Table.from_arrays(made, names=["id", "part", "start", "size", "container", "from_byte", "to_byte"][: len(made)])

    kind = dict(sizes.dtypes)["id"]
    more = ", from_byte long, to_byte long" if placed else ""
    return rows.groupBy("task").applyInArrow(run, f"id {kind}, part int, start long, size long, container long{more}")
