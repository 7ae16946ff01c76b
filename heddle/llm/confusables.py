"""Text that reads the same on screen, brought to one form: the confusables skeleton.

Decompose canonically, drop what is invisible, replace each character by its prototype, decompose again. Prototypes come,
in this order, from a short list of letters that keeps case apart, from a rule, the compatibility decomposition of kinds that
keep a sign's look (width, non-breaking, radicals, presentation forms, mathematical fonts), and from the Unicode table of
confusable characters, about 16,000, as the ICU library that comes with Spark holds it. Letter case, accents and digits stay:
those read differently. So do the look-alikes within ASCII (I and l, 0 and O, rn and m), unless they are asked for.
"""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from heddle.runtime import broadcast_if_small

#: Each character of the first string looks like the character at the same place of the second.
_LOOKALIKES = [
    ("аеорсухіѕјԛԝһѵԁ", "aeopcyxisjqwhvd"),  # Cyrillic, small
    ("АВЕЅІЈКМНОРСТУХԚԜҮѴ", "ABESIJKMHOPCTYXQWYV"),  # Cyrillic, capital
    ("ονρϲϳ", "ovpcj"),  # Greek, small
    ("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹͿ", "ABEZHIKMNOPTYXCJ"),  # Greek, capital
    ("օՕ", "oO"),  # Armenian
    ("ᎪᏴᏟᎠᎬᏀᎻᎫᏦᏞᎷᏢᏚᎢᏙᏔᏃ", "ABCDEGHJKLMPSTVWZ"),  # Cherokee
    ("ɡɑ", "ga"),  # Latin
    ("‐‑‒–−⁃˗", "-------"),
    ("’‘ʼʹ′", "'''''"),
    ("∣ǀ", "||"),
    ("∶", ":"),
    ("⁄∕", "//"),
    ("・‧∙⋅", "····"),
    ("∼〜", "~~"),
]
#: Kinds of compatibility decomposition that keep the look, by their tag in the Unicode data.
_SAME_LOOK = ("<wide>", "<narrow>", "<noBreak>", "<compat>", "<font>", "<initial>", "<medial>", "<final>", "<isolated>", "<vertical>", "<small>")
#: Invisible characters outside the category of format characters, as ranges.
_INVISIBLE = [(0x034F, 0x034F), (0x115F, 0x1160), (0x17B4, 0x17B5), (0x180B, 0x180F), (0x3164, 0x3164), (0xFE00, 0xFE0F), (0xFFA0, 0xFFA0), (0xE0000, 0xE0FFF)]
_VISIBLE_FORMAT = [(0x0600, 0x0605), (0x06DD, 0x06DD), (0x070F, 0x070F), (0x08E2, 0x08E2), (0x110BD, 0x110BD), (0x110CD, 0x110CD)]


class _Prototypes(dict):
    """The prototype of each code point, worked out when it is first met; ``table`` has what no rule gives."""

    def __init__(self, table: dict[str, str]):
        super().__init__({ord(x): y for a, b in _LOOKALIKES for x, y in zip(a, b, strict=True)})
        self.table = table
        self.ascii = any(c in table for c in "0Il")
        if self.ascii:
            self.update({ord(c): s for c, s in table.items() if c.isascii()})

    def __missing__(self, code: int) -> str:
        c = chr(code)
        kind = unicodedata.category(c)
        if c.isspace() or kind in ("Zs", "Zl", "Zp"):
            out = " "
        elif any(a <= code <= b for a, b in _INVISIBLE) or kind == "Cc" or (kind == "Cf" and not any(a <= code <= b for a, b in _VISIBLE_FORMAT)):
            out = ""
        else:
            tag = unicodedata.decomposition(c).partition(" ")[0]
            out = unicodedata.normalize("NFKD", c).translate(self) if tag in _SAME_LOOK else self.table.get(c, c)
        self[code] = out
        return out


_RULES = _Prototypes({})
_SPACES = re.compile(" +")
_BUILT: dict[int, _Prototypes] = {}


def unicode_table(spark: SparkSession, ascii_alike: bool = False) -> dict[str, str]:
    """Each character that Unicode lists as confusable, with its prototype; read from the ICU library in Spark's JVM.

    Bounded by Unicode, not by data. Empty where the JVM has no ICU; then the rules alone hold. Characters of ASCII are left
    out unless ``ascii_alike``.
    """
    try:
        checker = spark.sparkContext._jvm.com.ibm.icu.text.SpoofChecker.Builder().build()
    except TypeError:  # no such class
        return {}
    codes = [*range(0x21, 0xD800), *range(0xE000, 0x20000), *range(0x2F800, 0x2FA20)]
    chars = [c for c in map(chr, codes) if unicodedata.category(c) not in ("Cc", "Cf", "Cn", "Co", "Cs") and (ascii_alike or not c.isascii())]
    forms = checker.getSkeleton("\n".join(chars)).split("\n")
    return {c: s for c, s in zip(chars, forms, strict=True) if s != unicodedata.normalize("NFD", c)}


def skeleton(text: str | None, prototypes: _Prototypes = _RULES) -> str | None:
    """The skeleton of a text; equal for texts that read the same. Null stays null, and so does the empty text."""
    if text is None:
        return None
    if text.isascii() and text.isprintable() and not prototypes.ascii:
        return _SPACES.sub(" ", text).strip(" ")
    plain = unicodedata.normalize("NFD", unicodedata.normalize("NFD", text).translate(prototypes))
    return _SPACES.sub(" ", plain).strip(" ")


def skeleton_of(column: Column, ascii_alike: bool = False) -> Column:
    """The skeleton as a column; Arrow batches, each distinct text of a batch once."""
    spark = SparkSession.active()
    shared = spark.sparkContext.broadcast(unicode_table(spark, ascii_alike))

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        table = shared.value
        if id(table) not in _BUILT:
            if len(_BUILT) > 3:
                _BUILT.clear()  # of earlier queries
            _BUILT[id(table)] = _Prototypes(table)  # which keeps the table, so its id stays its own
        known = _BUILT[id(table)]
        codes, distinct = pd.factorize(texts, use_na_sentinel=True)
        made = pd.Series([*(skeleton(x, known) for x in distinct), None], dtype=object)
        return pd.Series(made.to_numpy()[codes], dtype=object)

    return run(column)


def match_display(df: DataFrame, *, id: str, column: str, vocab: DataFrame, vocab_id: str, vocab_column: str, ascii_alike: bool = False) -> DataFrame:
    """(rec_id, entry_id) for rows whose text reads like an entry of ``vocab`` but isn't spelled like any entry.

    With ``ascii_alike`` letters and digits of ASCII that look alike count as the same too.

    - Rows with null text match nothing, nor do texts without a visible character. Null entries of ``vocab`` are ignored.
    - Entries with the same skeleton are all given. Repeated rows come out each time. Very long texts are handled whole.
    - Empty tables give no rows. Further columns are not read, whatever their names.

    A map over the scan if the vocabulary is proved small enough to broadcast; otherwise joins that shuffle by skeleton.
    """
    entries = vocab.select(F.col(vocab_id).alias("entry_id"), F.col(vocab_column).alias("entry")).where(F.col("entry").isNotNull())
    forms = entries.select("entry_id", skeleton_of(F.col("entry"), ascii_alike).alias("form")).where(F.col("form") != "").distinct()
    rows = df.select(F.col(id).alias("rec_id"), F.col(column).alias("text")).where(F.col("text").isNotNull())
    rows = rows.withColumn("form", skeleton_of(F.col("text"), ascii_alike))
    hits = rows.join(broadcast_if_small(forms), "form")
    spelled = broadcast_if_small(entries.select(F.col("entry").alias("text")).distinct())
    return hits.join(spelled, "text", "left_anti").select("rec_id", "entry_id")


def skeleton_groups(df: DataFrame, *, column: str) -> DataFrame:
    """(form, spellings, rows, example) for each skeleton: its number of spellings and rows, and its least spelling.

    Null texts are left out; texts without a visible character share the empty skeleton. Spellings are counted before the
    shuffle by skeleton, so a form in a third of all rows arrives as one row for each spelling and task.
    """
    counts = df.select(F.col(column).alias("text")).where(F.col("text").isNotNull()).groupBy("text").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("form", skeleton_of(F.col("text"))).groupBy("form").agg(F.count(F.lit(1)).alias("spellings"), F.sum("n").alias("rows"), F.min("text").alias("example"))
