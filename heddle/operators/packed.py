"""Splitting fields that hold several addresses, guided by a dictionary of known whole values.

The dictionary comes out of the data itself. *Wholes* are values known whole, from places that hold just one (elements of JSON
lists, quoted values, columns of single addresses), in which the grammar alone would see several. *Fillers* are whole values
that are no address (``n/a``). *Tails* are what follows a delimiter inside a legitimate address (``|User-Agent=..``,
``;md5;..``, ``,19,72``), reduced to a mask so that they stay few. One automaton over wholes and fillers scans a field, its
other parts are looked up as tails, and dynamic programming picks the cover of the field that explains most of it: a stretch is
a known whole value, or the head of an address, a tail of the address before it, or filler. So heads and delimiters inside
known values are protected.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heddle.runtime import durable, hot_lookup

#: An address begins with a scheme or with ./ or ../
_HEAD = r"(?:[A-Za-z][A-Za-z0-9+.\-]*://|\.\.?/)"
#: Characters that separate values or stand around them; "$" only as "$$$".
_BREAKS = r"\s,，、;；|｜#"
_QUOTES = "\"'“”‘’`"
_HEAD_AT = re.compile(rf"(?:^|(?<=[{_BREAKS}{_QUOTES}\[])|(?<=\$\$\$))(?={_HEAD})")
_PIECE_AT = re.compile(rf"[{_BREAKS}]|\$\$\$")
_TRIM_L, _TRIM_R = re.compile(rf"^(?:[{_BREAKS}{_QUOTES}\[]|\$\$\$)+"), re.compile(rf"(?:[{_BREAKS}{_QUOTES}]|\$\$\$)+$")
_MASK_HEX, _MASK_NUM, _MASK_WORD = re.compile(r"[0-9a-fA-F]{16,}"), re.compile(r"\d+"), re.compile(r"(?<==)[^=&|;,#\s]+")
#: The same for Java's regular expressions.
_J_HEAD = rf"(?:^|(?<=[{_BREAKS}{_QUOTES}])|(?<=\$\$\$)){_HEAD}"


def mask_tail(text: str) -> str:
    """The form of a tail: long hexadecimal runs, numbers and values after = are each replaced by one sign."""
    return _MASK_NUM.sub("0", _MASK_WORD.sub("v", _MASK_HEX.sub("h", text)))


@dataclass(frozen=True)
class Dictionary:
    """Known values: masks of tails, fillers, wholes. ``table`` (kind, form) has all of them if the lists don't."""

    tails: list[str] = field(default_factory=list)
    fillers: list[str] = field(default_factory=list)
    wholes: list[str] = field(default_factory=list)
    table: DataFrame | None = None


def known_values(df: DataFrame, column: str, *, single: list[DataFrame] | None = None, most: int = 10_000, most_bytes: int = 8 << 20) -> Dictionary:
    """The dictionary of a column: from its fields that hold one value, and from ``single``, tables of one column of addresses.

    Counted over all rows, with partial aggregation. Up to ``most`` entries and ``most_bytes`` it goes to the workers as
    lists. Beyond that the lists hold the most frequent of each kind, and ``table`` has the rest, in which
    :func:`split_packed` looks up by a join what the lists don't know; so the bound costs time but no result.
    """
    v = F.trim(F.col(column))
    heads = F.regexp_count(v, F.lit(_J_HEAD))
    rows = df.select(v.alias("v"), heads.alias("n")).where(F.col("v").isNotNull() & (F.col("v") != ""))
    tail = F.regexp_extract("v", rf"^[{_QUOTES}]?{_HEAD}[^{_BREAKS}$]*((?:[{_BREAKS}]|\$\$\$).*)$", 1)
    mask = F.regexp_replace(F.regexp_replace(F.regexp_replace(tail, "[0-9a-fA-F]{16,}", "h"), r"(?<==)[^=&|;,#\s]+", "v"), r"\d+", "0")
    entry = lambda kind, form: F.struct(F.lit(kind).alias("kind"), form.alias("form"))
    one = (F.col("n") <= 1) & ~F.col("v").rlike(r"^[\[{]")
    listed = F.when(F.col("v").startswith("["), F.from_json("v", "array<string>"))
    quoted = F.flatten(F.array(*[F.regexp_extract_all("v", F.lit(f"{q}([^{q}]*){q}"), F.lit(1)) for q in ("\"", "'")]))
    held = F.when((F.col("n") >= 2) & F.col("v").rlike("^\\[|[\"']"), F.coalesce(listed, quoted))
    several = lambda x: F.trim(x).rlike(f"^{_HEAD}") & (F.regexp_count(F.trim(x), F.lit(_J_HEAD)) >= 2)
    found = F.when(one, F.array(F.when(F.col("n") == 1, entry("tail", mask)).otherwise(entry("filler", F.col("v"))))).otherwise(F.transform(F.filter(held, several), lambda x: entry("whole", F.trim(x))))
    entries = rows.select(F.explode(found).alias("e")).select("e.*")
    for t in single or []:
        value = t.select(F.trim(F.col(t.columns[0])).alias("v"))
        entries = entries.unionByName(value.where(several(F.col("v"))).select(F.lit("whole").alias("kind"), F.col("v").alias("form")))
    counts = durable(entries.where("form <> ''").groupBy("kind", "form").agg(F.count(F.lit(1)).alias("n")))
    size, n = counts.agg(F.coalesce(F.sum(F.octet_length("form")), F.lit(0)), F.count(F.lit(1))).first()
    cut = n > most or size > most_bytes
    if cut:
        w = Window.partitionBy("kind").orderBy(F.desc("n"), "form")
        top = counts.where(F.octet_length("form") <= 200).withColumn("r", F.row_number().over(w)).where(F.col("r") <= most)
    else:
        top = counts
    got: dict[str, list[str]] = {"tail": [], "filler": [], "whole": []}
    for r in top.select("kind", "form").collect():
        got[r.kind].append(r.form)
    return Dictionary(got["tail"], got["filler"], got["whole"], counts.select("kind", "form") if cut else None)


class _Known:
    """The automaton over wholes and fillers, and the masks of the pieces of tails; built once a Python worker."""

    def __init__(self, d: Dictionary):
        import ahocorasick

        self.tails = {mask_tail(x) for t in d.tails for x in _pieces(t)}
        self.auto = ahocorasick.Automaton()
        for kind, words in (("filler", d.fillers), ("whole", d.wholes)):
            for w in words:
                self.auto.add_word(w, (kind, len(w)))
        self.wholes = bool(d.wholes)
        if len(self.auto):
            self.auto.make_automaton()

    def spans(self, text: str, pieces: list[tuple[int, int]]) -> dict[int, list[tuple[int, str]]]:
        """For each piece the known values that begin with it, as (piece after the last, kind).

        A known value must fill its pieces: nothing but separators and quotes may stand beside it."""
        if not len(self.auto):
            return {}
        begin = {a + len(text[a:b]) - len(_TRIM_L.sub("", text[a:b])): i for i, (a, b) in reversed(list(enumerate(pieces)))}
        end = {a + len(_TRIM_R.sub("", text[a:b])): i for i, (a, b) in enumerate(pieces)}
        out: dict[int, list[tuple[int, str]]] = {}
        for last, (kind, size) in self.auto.iter(text):
            i, j = begin.get(last + 1 - size), end.get(last + 1)
            if i is not None and j is not None and j >= i:
                out.setdefault(i, []).append((j + 1, kind))
        return out


def _pieces(body: str) -> list[str]:
    at = [m.start() for m in _PIECE_AT.finditer(body)]
    return [body[a:b] for a, b in zip(at, [*at[1:], len(body)])]


def cover(sizes: list[int], heads: list[bool], tails: list[bool], blank: list[bool], spans: dict[int, list[tuple[int, str]]]) -> list[tuple[int, int]]:
    """The best cover of pieces by addresses, as (first piece, piece after the last).

    Dynamic programming over the pieces with two states, inside an address or not. A known whole value opens an address and
    gains most; a head opens one too. Another piece goes to the open address or is dropped. A known tail gains by its length
    when kept, filler when dropped; an unknown piece is kept, except one parted by white space, which no address contains.
    """
    n, low = len(sizes), float("-inf")
    at = [0]
    for s in sizes:
        at.append(at[-1] + s)
    # For each place and state: score, the place and state before, and whether an address begins there.
    best: list[list[tuple[float, int, int, bool]]] = [[(low, -1, -1, False)] * 2 for _ in range(n + 1)]
    best[0][0] = (0.0, -1, -1, False)

    def reach(i: int, state: int, score: float, j: int, was: int, opens: bool) -> None:
        if score > best[i][state][0]:
            best[i][state] = (score, j, was, opens)

    for i in range(n):
        for was in (0, 1):
            score = best[i][was][0]
            if score == low:
                continue
            for j, kind in spans.get(i, ()):
                size = at[j] - at[i]
                if kind == "whole":
                    reach(j, 1, score + 2 * size, i, was, True)
                elif not heads[i]:
                    reach(j, 0, score + size, i, was, False)
            if heads[i]:
                reach(i + 1, 1, score + sizes[i], i, was, True)
                continue
            if was:
                reach(i + 1, 1, score + (sizes[i] if tails[i] else -1 if blank[i] else 1), i, was, False)
            reach(i + 1, 0, score + (sizes[i] if blank[i] and not tails[i] else 0), i, was, False)
    i, state = n, 0 if best[n][0][0] >= best[n][1][0] else 1
    found: list[tuple[int, int]] = []
    stop = None
    while i > 0:
        _, j, was, opens = best[i][state]
        if state and stop is None:
            stop = i
        if opens:
            found.append((j, stop if stop is not None else i))
            stop = None
        i, state = j, was
    return found[::-1]


def segment(text: str | None, known: _Known, unknown: list[str] | None = None) -> list[str]:
    """The addresses in a field, in order. What of it no dictionary entry covers is added to ``unknown``."""
    if not text:
        return []
    s = text.strip()
    if s[:1] in ("[", "{", '"'):
        try:
            o = json.loads(s)
        except ValueError:
            o, s = None, s.rstrip("]") if s[0] == "[" else s  # not JSON: the brackets are wrapping
        if isinstance(o, dict):
            return [s]
        if isinstance(o, list):
            return [x.strip() for x in o if isinstance(x, str) and re.match(_HEAD, x.strip())]
        if isinstance(o, str):
            s = o
    starts = [m.start() for m in _HEAD_AT.finditer(s)]
    if not starts:
        return []
    at: list[tuple[int, int]] = []
    heads: list[bool] = []
    for a, b in zip(starts, [*starts[1:], len(s)]):
        b = a + len(_TRIM_R.sub("", s[a:b]))
        cuts = [a, *(m.start() for m in _PIECE_AT.finditer(s, a, b)), b]
        at += zip(cuts, cuts[1:])
        heads += [True] + [False] * (len(cuts) - 2)
    if all(heads) and not known.wholes and unknown is None:
        return [s[a:b] for a, b in at]
    pieces = [s[a:b] for a, b in at]
    tails = [not h and mask_tail(p) in known.tails for p, h in zip(pieces, heads)]
    spans = known.spans(s, at)
    if unknown is not None:
        filled = {k for i, to in spans.items() for j, _ in to for k in range(i, j)}
        unknown += [p for i, p in enumerate(pieces) if not tails[i] and i not in filled and (not heads[i] or len(starts) > 1)]
    taken = cover([len(p) for p in pieces], heads, tails, [p[:1].isspace() for p in pieces], spans)
    return [_TRIM_R.sub("", s[at[i][0] : at[j - 1][1]]) for i, j in taken]


def split_packed(df: DataFrame, *, id: str, column: str, least: int = 2, known: Dictionary | None = None) -> DataFrame:
    """One row for each address in fields of ``column`` that hold at least ``least``: (rec_id, pos, item).

    An address is a URL with a scheme or a path that starts with ./ or ../; query, fragment, checksum, header and other
    suffixes belong to it, as does a URL inside its query. Separators, quotes and white space around it don't. JSON text is
    decoded; a JSON object is one value. ``pos`` counts addresses from 1.

    - Null, empty, blank and unparsable fields, and fields with fewer addresses, give no row. Empty slots don't count.
    - Repeated addresses come out each time, and a repeated row (or id) gives its rows each time. A null id stays null.
    - Very long fields are handled whole, in time proportional to their length. An empty table gives no rows.
    - Further columns are not read, whatever their names.

    No shuffle: a map over the scan. Fields that can't hold ``least`` addresses are left out before Python sees them. Only if
    the dictionary is too large for lists are the distinct fields with parts unknown to the lists joined to all of it.
    """
    d = known if known is not None else known_values(df, column)
    maybe = F.coalesce(F.regexp_count(F.col(column), F.lit(r"://|\./|:\\/\\/|\.\\/|\\u00")), F.lit(0)) >= least
    rows = df.select(F.col(id).alias("rec_id"), F.col(column).cast("string").alias("v")).where(maybe)
    lists = Dictionary(d.tails, d.fillers, d.wholes)
    schema = f"rec_id {dict(rows.dtypes)['rec_id']}, pos int, item string"
    if d.table is None:
        return rows.mapInArrow(_splitter(lists, least, False), schema)
    first = durable(rows.mapInArrow(_splitter(lists, least, True), schema))
    rest = durable(first.where("pos = 0").groupBy(F.col("item").alias("v")).agg(F.count(F.lit(1)).alias("uses")))
    items = _split_by_join(rest, lists, d.table, least)
    again = hot_lookup(first.where("pos = 0").select("rec_id", F.col("item").alias("v")), durable(items), ["v"], "uses")
    return first.where("pos > 0").unionByName(again.select("rec_id", F.posexplode("items").alias("pos", "item")).withColumn("pos", F.col("pos") + 1))


def _splitter(lists: Dictionary, least: int, mark: bool):
    """Splits batches of (rec_id, v). With ``mark`` a field with parts unknown to the lists comes out whole as item 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dictionary = _Known(lists)
        for b in batches:
            row, pos, items = [], [], []
            for i, v in enumerate(b.column("v").to_pylist()):
                unknown: list[str] | None = [] if mark else None
                got = segment(v, dictionary, unknown)
                if unknown:
                    row.append(i)
                    pos.append(0)
                    items.append(v)
                elif len(got) >= least:
                    row.extend([i] * len(got))
                    pos.extend(range(1, len(got) + 1))
                    items.extend(got)
            made = [b.column("rec_id").take(pa.array(row, pa.int64())), pa.array(pos, pa.int32()), pa.array(items, pa.string())]
            yield pa.RecordBatch.from_arrays(made, names=["rec_id", "pos", "item"])

    return run


def _split_by_join(fields: DataFrame, lists: Dictionary, table: DataFrame, least: int) -> DataFrame:
    """(v, uses, items) of distinct fields, with those entries of the whole dictionary that each of them contains.

    Tails meet by their mask. Wholes and fillers meet by their first piece, and only those that the field contains stay, so
    what is gathered for a field is bounded by its length."""
    start = lambda x: _TRIM_L.sub("", x)

    def forms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dictionary = _Known(lists)
        for b in batches:
            key, kind, form = [], [], []
            for v in b.column("v").to_pylist():
                unknown: list[str] = []
                segment(v, dictionary, unknown)
                for p in set(unknown):
                    for k, f in (("tail", mask_tail(p)), ("value", _TRIM_R.sub("", start(p)))):
                        key.append(v)
                        kind.append(k)
                        form.append(f)
            yield pa.RecordBatch.from_arrays([pa.array(key, pa.string()), pa.array(kind, pa.string()), pa.array(form, pa.string())], names=["v", "kind", "form"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = []
            for v, kinds, words in zip(b.column("v").to_pylist(), b.column("kinds").to_pylist(), b.column("forms").to_pylist()):
                got: dict[str, list[str]] = {"tail": [*lists.tails], "filler": [], "whole": []}
                for k, w in zip(kinds or [], words or []):
                    got[k].append(w)
                inside = [x for x in lists.fillers if x in v], [x for x in lists.wholes if x in v]
                items = segment(v, _Known(Dictionary(got["tail"], got["filler"] + inside[0], got["whole"] + inside[1])))
                made.append(items if len(items) >= least else [])
            yield pa.RecordBatch.from_arrays([b.column("v"), b.column("uses"), pa.array(made, pa.list_(pa.string()))], names=["v", "uses", "items"])

    asked = durable(fields.select("v").mapInArrow(forms, "v string, kind string, form string"))
    pieces = F.regexp_extract(F.regexp_replace("form", rf"^(?:[{_BREAKS}{_QUOTES}\[]|\$\$\$)+", ""), rf"^(?:(?![{_BREAKS}]|\$\$\$).)*", 0)
    tails = table.where("kind = 'tail'").select(F.explode(F.split("form", rf"(?=[{_BREAKS}])|(?=\$\$\$)")).alias("form")).where("form <> ''").distinct()
    by_mask = asked.where("kind = 'tail'").join(tails, "form").select("v", F.lit("tail").alias("kind"), "form")
    values = table.where("kind <> 'tail'").select("kind", F.col("form").alias("word"), F.regexp_replace(pieces, rf"[{_QUOTES}]+$", "").alias("form"))
    by_start = asked.where("kind = 'value'").select("v", "form").join(values, "form").where(F.expr("contains(v, word)")).select("v", "kind", F.col("word").alias("form"))
    known = by_mask.unionByName(by_start).distinct().groupBy("v").agg(F.collect_list("kind").alias("kinds"), F.collect_list("form").alias("forms"))
    return fields.join(known, "v", "left").mapInArrow(learn, "v string, uses long, items array<string>")


def head_count(column: str | Column) -> Column:
    """How many addresses the plain grammar sees; for reports."""
    return F.regexp_count(F.col(column) if isinstance(column, str) else column, F.lit(_J_HEAD))
