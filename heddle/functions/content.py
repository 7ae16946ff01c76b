"""Column functions for file and response contents, hashes and buckets."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def md5_mod(c: Column, n: int) -> Column:
    """The 128-bit md5 of a text modulo ``n``, folded digit by digit of base 65536, as no built-in has the whole number."""
    h = F.md5(c)
    digits = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.conv(F.substr(h, i * 4 + 1, F.lit(4)), 16, 10).cast("long"))
    return F.aggregate(digits, F.lit(0).cast("long"), lambda a, x: (a * 65536 + x) % n)


def sha1_mod(c: Column, n: int) -> Column:
    """The 160-bit sha1 of a text modulo ``n``."""
    h = F.sha1(c)
    digits = F.transform(F.sequence(F.lit(0), F.lit(9)), lambda i: F.conv(F.substr(h, i * 4 + 1, F.lit(4)), 16, 10).cast("long"))
    return F.aggregate(digits, F.lit(0).cast("long"), lambda a, x: (a * 65536 + x) % n)


def sketch_value(c: Column) -> Column:
    """The first 48 bits of the md5 modulo 2^32."""
    return F.conv(F.substr(F.md5(c), F.lit(1), F.lit(12)), 16, 10).cast("long") % (1 << 32)


def canonical_hash(*columns: str) -> Column:
    """sha256 of a record as JSON with sorted keys and trimmed texts; nulls are kept as null."""
    fields = [F.trim(F.col(c).cast("string")).alias(c) for c in sorted(columns)]
    return F.sha2(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}), 256)


def canonical_json(c: Column) -> Column:
    """A JSON text in one form: keys sorted at every depth, texts trimmed, no blanks between; null for text that isn't JSON.

    Arrow batches, since no built-in sorts the keys of documents of any shape.
    """
    import json

    def tidy(x: object) -> object:
        if isinstance(x, dict):
            return {k: tidy(v) for k, v in sorted(x.items())}
        if isinstance(x, list):
            return [tidy(v) for v in x]
        return x.strip() if isinstance(x, str) else x

    def one(t: str) -> str | None:
        try:
            return json.dumps(tidy(json.loads(t)), ensure_ascii=False, separators=(",", ":"))
        except (ValueError, RecursionError):
            return None

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(one, na_action="ignore")

    return run(c)


def canonical_json_hash(c: Column) -> Column:
    """sha256 of :func:`canonical_json`."""
    return F.sha2(canonical_json(c), 256)


def failure_fingerprint(*parts: Column) -> Column:
    return F.substr(F.sha1(F.concat_ws("|", *parts)), F.lit(1), F.lit(8))


def magic_kind(c: Column) -> Column:
    """What a content is by how it begins; ``c`` may be text or bytes."""
    head = F.hex(F.substring(c.cast("binary"), 1, 64))
    lead = F.regexp_replace(head, "^(?:20|09|0A|0B|0C|0D)+", "")
    at = lambda *p: lead.rlike("^(?:" + "|".join(p) + ")")
    html = ["3C21444F4354595045", "3C21646F6374797065", "3C68746D6C"]
    wide = F.exists(F.sequence(F.lit(0), F.greatest(F.length(lead) / 2 - 1, F.lit(0)).cast("int")), lambda i: F.substr(lead, i * 2 + 1, F.lit(1)).rlike("[89A-F]"))
    return F.when(c.isNull(), F.lit(None)).when(at("504B0304"), "jar").when(at("1F8B"), "gzip").when(at(*html), "html").when(at("7B"), "json").when((lead != "") & wide, "binary").otherwise("text")


def suffix_mismatch(path: Column, kind: Column) -> Column:
    """Whether a .jar isn't one, or another suffix hides one."""
    ext = F.lower(F.regexp_extract(path, r"(\.[^./]*)$", 1))
    return F.when(ext == ".jar", ~kind.isin("jar", "binary")).otherwise((kind == "jar") & (ext != ".zip"))


def looks_like_stream(c: Column) -> Column:
    """Playlist text, or transport packets with their sync byte every 188 bytes, or FLV."""
    b = c.cast("binary")
    at = lambda i: F.hex(F.substring(b, i + 1, 1)) == "47"
    return F.coalesce(F.hex(F.substring(b, 1, 7)).eqNullSafe("23455854" + "4D3355") | F.hex(F.substring(b, 1, 3)).eqNullSafe("464C56") | (at(0) & at(188)), F.lit(False))


def body_shape(c: Column) -> Column:
    """live, html, json, bom or other, by the first characters of a body."""
    b = F.coalesce(c, F.lit(""))
    t = F.regexp_replace(b, "^[\\s\ufeff]+", "")
    return F.when(b.startswith("\ufeff"), "bom").when(t.rlike("^#EXTM3U") | t.rlike("(^|\\n)[^\\n]*,#genre#"), "live").when(t.rlike("^<(?i:!doctype|html)"), "html").when(t.rlike(r"^[\[{]"), "json").otherwise("other")


def response_class(code: Column, body: Column) -> Column:
    """E2 parsable, E1 answers but no data, E0 dead, E? undecided."""
    shape = body_shape(body)
    ok = code.between(200, 299)
    return F.when(ok & shape.isin("json", "live"), "E2").when(ok & (F.length(F.trim(body)) > 0), "E1").when(code.isin(404, 410) | (code >= 500), "E0").otherwise("E?")


def is_rule(c: Column) -> Column:
    """JSON, an array or XML, but no web page and not blank."""
    t = F.trim(F.coalesce(c, F.lit("")))
    return t.rlike(r"^(?:[\[{]|<\?xml|<rss)") & ~t.rlike("^<(?i:!doctype|html)")
