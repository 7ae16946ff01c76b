"""Column functions for names, labels and paths."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from heddle.functions.urls import text

#: A few traditional characters and their simplified forms; callers may pass their own.
TRAD = ("電視衛綜藝體聞劇場臺灣國際頻道東廣鳳凰華紀實樂兒經濟愛龍馬魚鳥車門開關見長風飛黃", "电视卫综艺体闻剧场台湾国际频道东广凤凰华纪实乐儿经济爱龙马鱼鸟车门开关见长风飞黄")
_FULL = "".join(chr(c) for c in range(0xFF01, 0xFF5F))
_HALF = "".join(chr(c) for c in range(0x21, 0x7F))
#: Names that Windows keeps for devices, and characters it doesn't allow.
RESERVED = ["CON", "PRN", "AUX", "NUL", *[f"COM{i}" for i in range(1, 10)], *[f"LPT{i}" for i in range(1, 10)]]
_BAD = r'[<>:"|?*\\\x00-\x1f]'


def norm_key(c: Column) -> Column:
    return F.regexp_replace(F.lower(text(c)), r"[\s_\-·•]+", "")


def title_norm(c: Column) -> Column:
    """Letters, digits and ideographs only, lower case."""
    return F.lower(F.regexp_replace(F.coalesce(c, F.lit("")), r"[^\p{L}\p{N}]+", ""))


def normalize_name(c: Column, trad: tuple[str, str] = TRAD) -> Column:
    """Bracketed tags off, half width, simplified, lower case, separators off."""
    n = F.regexp_replace(text(c), r"^(?:[【\[][^】\]]*[】\]]\s*)+", "")
    n = F.translate(F.translate(F.replace(n, F.lit("　"), F.lit(" ")), _FULL, _HALF), *trad)
    return F.regexp_replace(F.lower(n), r"[\s_\-·•|┃.]+", "")


def traditional_table(spark: SparkSession) -> tuple[str, str]:
    """All single traditional characters and their simplified forms, as the ICU library in Spark's JVM has them; the few of
    ``TRAD`` where it is missing."""
    try:
        simple = spark.sparkContext._jvm.com.ibm.icu.text.Transliterator.getInstance("Traditional-Simplified")
    except TypeError:  # no such class
        return TRAD
    chars = [chr(i) for i in (*range(0x3400, 0xA000), *range(0xF900, 0xFB00))]
    pairs = [(a, b) for a, b in zip(chars, simple.transliterate("\n".join(chars)).split("\n"), strict=True) if a != b and len(b) == 1]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def latency_label(c: Column) -> Column:
    """N of a [Nms] label; null without one."""
    return F.nullif(F.regexp_extract(c, r"\[(\d{1,9})ms", 1), F.lit("")).try_cast("int")


def group_core(c: Column) -> Column:
    return F.regexp_replace(F.coalesce(c, F.lit("")), "^(综合|4K)-", "")


def upstream_tag(origin: Column, key: Column) -> Column:
    """At most 12 characters of an origin's last part without its number; else 8 of the key, else unk."""
    last = F.regexp_replace(F.element_at(F.split(origin, "/"), -1), r"^\d+-", "")
    k = F.coalesce(key, F.lit(""))
    return F.when(F.coalesce(origin, F.lit("")) != "", F.substr(last, F.lit(1), F.lit(12))).when(k != "", F.substr(k, F.lit(1), F.lit(8))).otherwise("unk")


def quality_score(name: Column, searchable: Column, quick: Column, api: Column) -> Column:
    yes = lambda c, n: F.when(c, n).otherwise(0)
    return yes(F.coalesce(name, F.lit("")).rlike(r"\[\d+ms"), 10) + yes(searchable == 1, 5) + yes(quick == 1, 3) + yes(F.coalesce(api, F.lit("")) != "", 2)


def dated_name(c: Column) -> Column:
    """The date in snapshot-YYYYMMDD.zip or vYYYY-MM-DD-bN; null for other names and impossible dates."""
    d = F.regexp_replace(F.regexp_extract(F.coalesce(c, F.lit("")), r"^(?:snapshot-(\d{8})\.zip|v(\d{4}-\d{2}-\d{2})-b\d+)$", 1), "-", "")
    e = F.replace(F.regexp_extract(F.coalesce(c, F.lit("")), r"^v(\d{4}-\d{2}-\d{2})-b\d+$", 1), F.lit("-"), F.lit(""))
    return F.try_to_date(F.nullif(F.concat(d, e), F.lit("")), "yyyyMMdd")


def safe_segment(c: Column) -> Column:
    """A path part that every file system takes."""
    s = F.rtrim(F.regexp_replace(F.coalesce(c, F.lit("_")), _BAD, "_"), F.lit(" ."))
    s = F.when(s == "", F.lit("_")).otherwise(s)
    return F.when(F.upper(F.element_at(F.split(s, r"\."), 1)).isin(RESERVED), F.concat(F.lit("_"), s)).otherwise(s)


def safe_path(c: Column) -> Column:
    parts = F.filter(F.split(F.replace(F.coalesce(c, F.lit("")), F.lit("\\"), F.lit("/")), "/"), lambda s: ~s.isin("", ".", ".."))
    joined = F.array_join(F.transform(parts, safe_segment), "/")
    return F.when(joined == "", F.lit("_")).otherwise(joined)


def capped_path(c: Column, most: int = 200) -> Column:
    """A path over ``most`` characters has its last part replaced by a hash that keeps the suffix."""
    last = F.element_at(F.split(c, "/"), -1)
    short = F.concat(F.substr(F.md5(last), F.lit(1), F.lit(16)), F.regexp_extract(last, r"[^.](\.[^.]*)$", 1))
    folder = F.regexp_extract(c, r"^(.*/)[^/]*$", 1)
    return F.when(F.length(c) <= most, c).otherwise(F.concat(folder, short))


def windows_reason(c: Column, most: int = 240) -> Column:
    """Why a path can't be made on Windows, by the first failing rule; empty if it can."""
    p = F.coalesce(c, F.lit(""))
    why = lambda s: F.when(s == "", "empty segment").when(s.rlike(_BAD), "illegal character").when(s.rlike(r"[ .]$"), "ends with dot or space").when(F.upper(F.element_at(F.split(s, r"\."), 1)).isin(RESERVED), "reserved name")
    first = F.try_element_at(F.filter(F.transform(F.split(F.replace(p, F.lit("\\"), F.lit("/")), "/"), why), lambda x: x.isNotNull()), F.lit(1))
    return F.when(p == "", "empty path").otherwise(F.coalesce(first, F.when(F.length(p) > most, "too long"), F.lit("")))


def channel_class(name: Column, marker: Column, blocked: str = "(?!)", regions: str = "香港|澳门|台湾|港澳", loops: str = "轮播|循环", loop_exclude: str = "新闻", local: str = "省|市|县|地方|少儿|卫视") -> Column:
    """The class of a channel by the first rule that fits: source marker, quarantine, number, region, loop, local, other."""
    n = F.coalesce(name, F.lit(""))
    number = F.nullif(F.regexp_extract(F.upper(n), r"(?:CCTV|[A-Z]{3})[-\s]?(\d{1,2})(?:\D|$)", 1), F.lit("")).try_cast("int")
    m = F.coalesce(marker, F.lit(""))
    return F.when(m != "", F.concat(F.lit("source:"), m)).when(n.rlike(blocked), "quarantine").when(number.between(1, 17), "numbered").when(n.rlike(regions), "region").when(n.rlike(loops) & ~n.rlike(loop_exclude), "loop").when(n.rlike(local), "local").otherwise("other")
