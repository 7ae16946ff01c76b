"""Column functions for addresses; all native expressions. Null and missing values give the empty string unless noted."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Mirror prefixes that are put before another address.
PROXY_HOSTS = ("ghproxy.net", "gh-proxy.com", "ghfast.top", "mirror.ghproxy.com", "ghproxy.com")


def text(c: Column) -> Column:
    return F.regexp_replace(F.coalesce(c, F.lit("")), r"^\s+|\s+$", "")


def strip_proxy(c: Column, hosts: tuple[str, ...] = PROXY_HOSTS) -> Column:
    """Without any number of mirror prefixes in front."""
    quoted = "|".join(h.replace(".", "\\.") for h in hosts)
    return F.regexp_replace(c, rf"^(?i:(?:https?://)?(?:{quoted})/)+(?=https?://)", "")


def canonical_url(c: Column, hosts: tuple[str, ...] = PROXY_HOSTS) -> Column:
    """Host and path as an identity: no mirror prefix, scheme, www., default port, fragment or trailing slash; host in
    lower case, path and query as they are."""
    u = F.regexp_replace(strip_proxy(text(c), hosts), r"(?s)(?:/+#|#).*$|/+$", "")
    u = F.regexp_replace(u, r"^(?i)(https://[^/?]*):443(?=[/?]|$)|^((?:http://)?[^/?:]*):80(?=[/?]|$)", "$1$2")
    u = F.regexp_replace(u, r"^(?i)(?:https?://)?(?:www\.)?", "")
    return F.concat(F.lower(F.regexp_extract(u, r"^[^/?]*", 0)), F.regexp_extract(u, r"(?s)^[^/?]*(.*)$", 1))


def norm_url(c: Column) -> Column:
    """The canonical form of http addresses; other values only trimmed."""
    u = text(c)
    return F.when(u.rlike("^(?i)https?://"), canonical_url(u)).otherwise(u)


def norm_api(c: Column) -> Column:
    return F.lower(norm_url(c))


def parse_url_norm(c: Column) -> Column:
    """Endpoint form: http becomes https, host lower case, no trailing slash; placeholders and other schemes stay."""
    u = text(c)
    tail = F.regexp_replace(u, r"^(?i)https?://", "")
    made = F.concat(F.lit("https://"), F.lower(F.regexp_extract(tail, r"^([^/]*)", 1)), F.regexp_replace(F.regexp_extract(tail, r"(?s)^[^/]*(.*)$", 1), r"/+$", ""))
    return F.when(u.rlike("^(?i)https?://"), made).otherwise(u)


def host_of(c: Column) -> Column:
    """Host with port, lower case; empty without a scheme."""
    return F.lower(F.regexp_extract(text(c), r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#]*)", 1))


def path_norm(c: Column) -> Column:
    """Relative path: leading dots and slashes off, one kind of slash, no empty or . parts."""
    p = F.ltrim(F.replace(F.coalesce(c, F.lit("")), F.lit("\\"), F.lit("/")), F.lit("./"))
    return F.array_join(F.filter(F.split(p, "/"), lambda s: (s != "") & (s != ".")), "/")


def bare_ref(c: Column) -> Column:
    """A reference without its checksum suffix and mirror prefix."""
    return strip_proxy(F.regexp_replace(text(c), r"(?is);md5;.*$", ""))


def split_refs(c: Column) -> Column:
    """Relative file references in a field: parts between $$$, each cut at ; and kept if it starts with ./ or ../"""
    parts = F.transform(F.split(F.coalesce(c, F.lit("")), r"\$\$\$"), lambda x: text(F.regexp_replace(x, "(?s);.*$", "")))
    return F.filter(parts, lambda x: x.rlike(r"^\.{1,2}/"))


def remote_list(c: Column) -> Column:
    """Remote addresses in a field, without loopback and private hosts."""
    found = F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(r"(https?://[^\s\"',;$|#\\\[\]]+)"), F.lit(1))
    return F.filter(found, lambda u: ~u.rlike(r"^https?://(?:localhost|127\.|10\.|192\.168\.|172\.(?:1[6-9]|2[0-9]|3[01])\.|0\.0\.0\.0)"))


def url_class(c: Column) -> Column:
    u = text(c)
    return F.when(u == "", "no_url").when(u.rlike(r"^(\./|\.\./|/|file:)"), "local").when(u.rlike(r"^(?i)https?://[^/]*(github|ghproxy)"), "gh").when(u.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), "direct").otherwise("no_url")


def quote_path(c: Column) -> Column:
    """Percent-encodes each part of the path and nothing else."""
    u = text(c)
    head, path, tail = F.regexp_extract(u, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1), F.regexp_extract(u, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)?([^?#]*)", 1), F.regexp_extract(u, r"(?s)^[^?#]*(.*)$", 1)
    quoted = F.array_join(F.transform(F.split(path, "/"), lambda s: F.replace(F.replace(F.url_encode(s), F.lit("+"), F.lit("%20")), F.lit("%7E"), F.lit("~"))), "/")
    return F.concat(head, quoted, tail)


def repo_ref(c: Column) -> Column:
    """struct(owner, repo, ref, path) of a raw file address of a code host; null if it is none or climbs out of its root."""
    u = strip_proxy(text(c))
    pattern = r"^https?://raw\.githubusercontent\.com/([^/]+)/([^/]+)/(?:refs/heads/)?([^/]+)/([^?#]+)"
    parts = [F.regexp_extract(u, pattern, i).alias(n) for i, n in enumerate(("owner", "repo", "ref", "path"), 1)]
    return F.when(u.rlike(pattern) & ~u.rlike(r"(^|/)\.\.(/|$)"), F.struct(*parts))


def local_name(c: Column) -> Column:
    """A file name for an address: ten digits of its md5 and its last part."""
    base = F.regexp_extract(F.regexp_replace(text(c), r"(?s)[?#;].*$", ""), r"([^/]*)/*$", 1)
    return F.concat(F.substr(F.md5(text(c)), F.lit(1), F.lit(10)), F.lit("-"), base)


def miss_reason(code: Column, path: Column, html: Column) -> Column:
    """Why an address is surely gone: only a 404 or 410 for a file, or a web page in place of a file."""
    file = path.rlike(r"/[^/?#]+\.[A-Za-z0-9]{1,5}([?#].*)?$")
    return F.when(file & code.isin(404, 410), F.concat(F.lit("gone-"), code.cast("string"))).when(file & html, "lander-html").otherwise("")


def harvest_links(c: Column, *, keep: str | None = None, drop: str | None = None) -> Column:
    """The distinct links in a text in their order, trailing punctuation off; only those that ``keep`` finds something in and
    ``drop`` finds nothing in (regular expressions)."""
    found = F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(r"(https?://[^\s<>\"'()\[\]，。、；]+)"), F.lit(1))
    links = F.array_distinct(F.transform(found, lambda u: F.regexp_replace(u, r"[.,;:!?]+$", "")))
    if keep is not None:
        links = F.filter(links, lambda u: u.rlike(keep))
    return F.filter(links, lambda u: ~u.rlike(drop)) if drop is not None else links
