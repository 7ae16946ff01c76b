"""Pages made of repeated keywords, link lists or tag lists rather than sentences.

Lines are cut into pieces at sentence ends, and each piece is reduced to a shape: its words by number and capitals, the
separators between them, its links, tags and label:value pairs, and whether it ends like a sentence. Nothing depends on a
language: words are runs of letters of any script, and in scripts that put no space between words, stretches of signs stand for
words. Pieces of one shape are grouped, and a page is flagged if a few shapes that no sentence has hold more than half of
its characters. Keywords dressed up as sentences have a sentence's shape; they are known by repeating their word pairs
inside a sentence as well as from one sentence to the next.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Scripts without spaces between words, by their blocks: first alphabets (Thai to Tibetan, Myanmar, Khmer), in which about
#: five signs make a word, then kana, bopomofo and ideographs, in which two do.
_FIRST_UNSPACED = "\u0e00"
_ALPHABETS = "฀-࿿က-႟ក-៿"
_UNSPACED = "฀-࿿က-႟ក-៿ぁ-ヿㄅ-ㄯ㐀-䶿一-鿿豈-﫿\U00020000-\U0003ffff"
#: Signs inside words that count as no letters: combining accents and points, and the vowel signs of Indic scripts.
_MARKS = "̀-֑ͯ-ֽؐ-ًؚ-ٰٟऀ-ॣ०-෿"
#: What ends a sentence; the first kind needs white space after it.
_STOPS, _WIDE_STOPS = ".!?…؟۔।॥։።", "。！？｡။។"

_LINK = re.compile(r"(?:[A-Za-z][A-Za-z0-9+.\-]*://|www\.)[^\s<>\"'，。、]+")
_TAG = re.compile(r"#[^\s#,，、;；|]+")
_PAIR = re.compile(r"[^\s:：,，、;；|#]{1,12}[:：](?!//)[^\s:：,，、;；|#]{1,20}")
_MARKUP = re.compile(r"<[^<>\n]{1,80}>|&[a-z]+;")
_BULLET = re.compile(r"^(?:[\s>*•+\-–—]|\d{1,4}[.)、:：]\s?)+")
_QUOTED = re.compile(r"^[\s>]*")
_CUT = re.compile(rf"(?<=[{_WIDE_STOPS}])|(?<=[{_STOPS}])\s+")
_ENDS = re.compile(rf"[{_STOPS}{_WIDE_STOPS}][\"'”’」』»)）\]*_]*$")
_FIELDS = re.compile(r"[,，、،;；؛|｜·•/\t]+|\s[-–—]\s")
_ASCII_WORD = re.compile(r"[A-Za-z0-9]+(?:'[A-Za-z]+)*")
_WORD = re.compile(rf"[{_UNSPACED}]+|(?:[^\W_{_UNSPACED}]|[{_MARKS}])+(?:['’][^\W_{_UNSPACED}]+)*")
_UNSPACED_AT = re.compile(f"[{_UNSPACED}]")
_ALPHABET_AT = re.compile(f"[{_ALPHABETS}]")


@dataclass(frozen=True)
class ShapeConfig:
    """``share``: of the characters, above which a page is flagged, held by at most ``few`` shapes. ``repeats``: pieces of one
    short shape that make a list; a piece is short up to ``short`` words. ``fields``: fields between separators that make a
    list if they have at most ``field_words`` words on average; twice as many if the piece ends like a sentence.
    ``run``: words from which a piece is a list that repeats a share of ``again`` of its word pairs or of ``same`` of its words,
    or of which one word makes up ``most``. ``wrapped``: characters of
    a line that the next one may continue. Sentences are stuffed if they repeat a share of ``within`` of their word pairs
    inside themselves and ``around`` of them occur ``times`` times in the ``near`` sentences on either side."""

    share: float = 0.5
    few: int = 12
    repeats: int = 4
    short: float = 8
    fields: int = 4
    field_words: float = 3
    run: int = 12
    again: float = 0.28
    same: float = 0.45
    most: float = 0.33
    caps: float = 0.75
    wrapped: int = 30
    near: int = 3
    times: int = 3
    within: float = 0.05
    around: float = 0.25


def _units(words: list[str]) -> list:
    """Pairs of neighbouring words; within a run of an unspaced script all its stretches of two signs, or five of an alphabet."""
    out: list = []
    last = None
    for w in words:
        if w[0] >= _FIRST_UNSPACED and _UNSPACED_AT.match(w):
            if _ALPHABET_AT.match(w):
                out += [w[i : i + 5] for i in range(max(1, len(w) - 4))]
            else:
                out += map(str.__add__, w, w[1:]) if len(w) > 1 else w
            last = None
        else:
            if last is not None:
                out.append((last, w))
            last = w
    return out


def _repeats(units: list, words: list[str], c: ShapeConfig) -> bool:
    """Whether a piece says the same again and again. Taken over stretches of a hundred, since any long text repeats itself."""
    if _again(units) >= c.again * len(units):
        return True
    same = _again(words)
    if len(words) >= 2 * c.run and same >= c.same * len(words):
        return True
    return same >= c.most * len(words) and max(Counter(words).values()) >= c.most * len(words)


def _again(items: list) -> int:
    if len(items) <= 100:
        return len(items) - len(set(items))
    return sum(len(x) - len(set(x)) for x in (items[i : i + 100] for i in range(0, len(items), 100)))


def shape_of(piece: str, c: ShapeConfig = ShapeConfig(), alone: bool = True) -> tuple[str, str, list]:
    """The kind of a piece (sentence, list or short), its shape, and for a sentence its units. ``alone``: it is a whole line."""
    n = len(piece)
    rest = piece
    if "://" in piece or "www." in piece:
        if sum(map(len, _LINK.findall(piece))) * 2 >= n:
            return "list", "links", []
        rest = _LINK.sub(" ", piece)
    if "#" in piece and sum(map(len, _TAG.findall(piece))) * 2 >= n:
        return "list", "tags", []
    if ":" in piece or "：" in piece:
        pairs = [len(x) for x in _PAIR.findall(piece)]
        if len(pairs) >= 3 and sum(pairs) * 3 >= n:
            return "list", "pairs", []
    find, blocks = (_ASCII_WORD if rest.isascii() else _WORD).findall, []
    low = find(rest.lower())
    size = float(len(low))
    if not rest.isascii():
        blocks = [w for w in low if w[0] >= _FIRST_UNSPACED and _UNSPACED_AT.match(w)]
        size += sum(len(w) / (5 if _ALPHABET_AT.match(w) else 2) - 1 for w in blocks)
    ends = bool(_ENDS.search(piece))
    parts = [f for f in _FIELDS.split(rest) if f.strip()]
    if len(parts) >= c.fields * (1 + ends) and size <= c.field_words * len(parts):
        return "list", f"fields{'.' if ends else ''}", []
    if blocks and not ends:
        apart = [x for x in rest.split() if _UNSPACED_AT.match(x)]
        if len(apart) >= c.fields and sum(len(x) / (5 if _ALPHABET_AT.match(x) else 2) for x in apart) <= c.field_words * len(apart):
            return "list", "fields", []
    units = _units(low) if blocks else list(zip(low, low[1:]))
    if size >= c.run and _repeats(units, low, c):
        return "list", "run", []
    if size <= c.short and (alone or not ends):
        caps = "".join("W" if w[0].isupper() else "0" if w[0].isdigit() else f"c{min(len(w), 12)}" if _UNSPACED_AT.match(w) else "w" for w in find(rest)[:8])
        return "short", caps + ("s" if len(parts) > 1 else ""), []
    if not ends and len(low) >= c.short:
        cased = [w for w in find(rest) if w[0].lower() != w[0].upper()]
        if len(cased) >= c.short and sum(w[0].isupper() for w in cased) >= c.caps * len(cased):
            return "list", "names", []
    return "sentence", "sentence", units


def stuffed(sentences: list[tuple[int, list]], c: ShapeConfig) -> int:
    """The size of those (size, units) sentences whose units come up again and again in the sentences around them.

    Keywords are also repeated inside a sentence. Sentences that are only alike, as in a log, repeat words from one to the
    next but not within, and count for nothing.
    """
    inside = sum(len(u) - len(set(u)) for _, u in sentences)
    if inside < c.within * sum(len(u) for _, u in sentences) or inside < 2:
        return 0
    near: Counter = Counter()
    found: list[tuple[int, list]] = []
    for i in range(min(c.near, len(sentences))):
        near.update(sentences[i][1])
    for i, (_, units) in enumerate(sentences):
        if i + c.near < len(sentences):
            near.update(sentences[i + c.near][1])
        if i > c.near:
            near.subtract(sentences[i - c.near - 1][1])
        if units and sum(near[u] >= c.times for u in units) >= c.around * len(units):
            found.append(sentences[i])
    repeated = sum(len(u) - len(set(u)) for _, u in found)
    return sum(n for n, _ in found) if repeated >= c.within * sum(len(u) for _, u in found) else 0


def _lines(text: str, c: ShapeConfig) -> Iterator[tuple[int, str]]:
    """(size, content) of lines without markup and bullets; a long line that a small letter goes on from is put together."""
    size, held, bare = 0, "", False
    for line in text.split("\n"):
        body = (_MARKUP.sub("", line) if "<" in line or "&" in line else line).strip()
        if not body:
            continue
        plain = _QUOTED.sub("", body)
        if held and plain and len(held) >= c.wrapped and bare and not plain[0].isupper() and plain[0].isalpha() and not _ENDS.search(held) and "://" not in held and "://" not in plain:
            held, size = f"{held} {plain}", size + len(body) + 1
            continue
        if size:
            yield size, held
        held, size = _BULLET.sub("", body), len(body) + 1
        bare = len(held) == len(plain)
    if size:
        yield size, held


def list_share(text: str | None, c: ShapeConfig = ShapeConfig()) -> float:
    """The share of a text's characters in its few greatest non-sentence shapes; 0 for null and blank texts."""
    if not text or not text.strip():
        return 0.0
    total = in_sentences = 0
    held: Counter[tuple[str, str]] = Counter()
    count: Counter[tuple[str, str]] = Counter()
    sentences: list[tuple[int, list]] = []
    for whole, line in _lines(text, c):
        total += whole
        pieces = [p for p in _CUT.split(line) if p]
        extra = whole - len(line)  # bullet, markup and line end count with the first piece
        for piece in pieces:
            kind, shape, units = shape_of(piece, c, len(pieces) == 1)
            size, extra = len(piece) + extra, 1
            if kind == "sentence":
                sentences.append((size, units))
                in_sentences += size
            else:
                held[kind, shape] += size
                count[kind, shape] += 1
    listed = [n for (kind, shape), n in held.items() if kind == "list" or count[kind, shape] >= c.repeats]
    if sentences and 2 * (sum(listed) + in_sentences) > total:
        listed.append(stuffed(sentences, c))
    return min(1.0, sum(sorted(listed)[-c.few :]) / total) if total else 0.0


def list_pages(df: DataFrame, *, id: str, text: str, config: ShapeConfig = ShapeConfig()) -> DataFrame:
    """(id, share) for pages of which more than ``config.share`` of the characters are in a few non-sentence shapes.

    - Null, empty and blank texts, and texts of one short piece, are never flagged. A null id is kept as null.
    - Repeated rows come out each time. Texts of any length are read whole. An empty table gives no rows.
    - Further columns are not read, whatever their names.

    A map over the scan; no shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            share = pa.array([list_share(t, config) for t in b.column("text").to_pylist()], type=pa.float64())
            yield pa.RecordBatch.from_arrays([b.column("id"), share], names=["id", "share"])

    kind = dict(df.dtypes)[id]
    rows = df.select(F.col(id).alias("id"), F.col(text).alias("text")).where(F.col("text").isNotNull())
    return rows.mapInArrow(run, f"id {kind}, share double").where(F.col("share") > config.share)
