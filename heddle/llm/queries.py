"""Queries of the training-data problems, and DuckDB's SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heddle.llm.components import link_groups
from heddle.llm.confusables import match_display, skeleton_groups
from heddle.llm.formats import address_form, collapse_formats, format_copies, format_firsts, plain_form
from heddle.llm.fusion import decide_newest, golden_records, survivors
from heddle.llm.leaks import leaked_passages
from heddle.llm.packing import pack, token_sizes
from heddle.llm.setjoin import similar_counts, similar_pairs
from heddle.llm.shapes import list_pages
from heddle.runtime import durable, table

#: Levels from best to worst.
LEVELS = ["L3", "L2", "L1", "L?", "L0", "S1", "S0"]
#: Tokens in a container.
CAPACITY = 2048
_SITE_FIELDS = {"key": plain_form, "name": plain_form, "api": address_form}


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return link_groups(table(spark, d, "mirror_groups").where("is_match"), a="key", b="peer_key")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    pairs = similar_pairs(table(spark, d, "sites_probe"), id="probe_id", type="type", values="names", threshold=0.7, least=5)
    return pairs.select(F.col("id_a").alias("probe_a"), F.col("id_b").alias("probe_b"))


def p2_links(spark: SparkSession, d: str) -> DataFrame:
    counts = similar_counts(table(spark, d, "sites_probe"), id="probe_id", type="type", values="names", threshold=0.7, least=5)
    return counts.select(F.col("id").alias("probe_id"), "class_id", "links")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    lives = table(spark, d, "lives").select(F.lit("lives").alias("rec_kind"), F.col("live_id").alias("rec_id"), "name")
    sites = table(spark, d, "sites").select(F.lit("sites").alias("rec_kind"), F.col("row_id").alias("rec_id"), "name")
    rows = lives.unionByName(sites).select(F.struct("rec_kind", "rec_id").alias("rec"), "name")
    found = match_display(rows, id="rec", column="name", vocab=table(spark, d, "name_vocab"), vocab_id="name_id", vocab_column="display_name")
    return found.select("rec_id.rec_kind", "rec_id.rec_id", F.col("entry_id").alias("name_id"))


def p3_forms(spark: SparkSession, d: str) -> DataFrame:
    names = table(spark, d, "lives").select("name").unionByName(table(spark, d, "sites").select("name"))
    return skeleton_groups(names, column="name").where("spellings > 1").select("example", "spellings", "rows")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return format_copies(table(spark, d, "sites"), id="row_id", fields=_SITE_FIELDS)


def p4_records(spark: SparkSession, d: str) -> DataFrame:
    return collapse_formats(table(spark, d, "sites"), id="row_id", fields=_SITE_FIELDS)


def _level_claims(spark: SparkSession, d: str) -> DataFrame:
    """What comparisons say about each key's level; a source is a batch and the side of the comparison that the key is on."""
    t = table(spark, d, "mirror_groups")
    side = lambda name: F.concat(F.col("generated_at").cast("string"), F.lit(name)).alias("said_by")
    both = t.select("key", "level", "generated_at", side(" key")).unionByName(t.select(F.col("peer_key").alias("key"), F.col("peer_level").alias("level"), "generated_at", side(" peer")))
    level = F.upper(F.regexp_replace("level", r"(?U)\s+", ""))
    return both.select("key", F.when(level != "", level).alias("level"), "generated_at", "said_by")


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    probes = table(spark, d, "sites_probe")
    level = decide_newest(_level_claims(spark, d), entity="key", source="said_by", value="level", at="generated_at")
    times = probes.select("key", "ms", "generated_at", F.concat_ws(" ", F.col("generated_at").cast("string"), "type").alias("said_by"))
    ms = decide_newest(times, entity="key", source="said_by", value="ms", at="generated_at")
    named = probes.where(F.col("key").isNotNull() & F.col("name").rlike(r"(?U)\S")).groupBy("key").agg(F.max("generated_at").alias("at"))
    return survivors(p1_found(spark, d), level, ms, named, LEVELS)


def p7_fused(spark: SparkSession, d: str) -> DataFrame:
    """One site record for each group of formatting duplicates: every field by what the sources that deliver it say.

    Groups have at least two records. A record without copies is its own survivor; with nothing to compare it with, it says
    nothing about its source, and its posterior would only repeat what is held of that source.
    """
    sites = table(spark, d, "sites")
    firsts = format_firsts(sites, id="row_id", fields=_SITE_FIELDS)
    records = sites.select(F.col("row_id").alias("id"), "src", "name", "group_name", "jar", "searchable", "quick_search").join(firsts, "id")
    made = golden_records(records, entity="first_id", source="src", fields=["name", "group_name", "jar", "searchable", "quick_search"])
    return made.select(F.col("entity").alias("first_id"), "field", "value", F.round("posterior", 6).alias("posterior"))


def p8_pack(spark: SparkSession, d: str) -> DataFrame:
    sizes = token_sizes(table(spark, d, "documents"), id="doc_id", text="text", capacity=CAPACITY)
    return pack(sizes, CAPACITY).select(F.col("id").alias("doc_id"), "part", "start", F.col("size").alias("tokens"), "container", "from_byte", "to_byte")


def p8_covered(spark: SparkSession, d: str) -> DataFrame:
    """For each document how many bytes its pieces cover, and whether they are sound: without gap or overlap, more than one only
    if the document is too long for a container, and in containers that hold no more than they can."""
    pieces = durable(p8_pack(spark, d))
    over = pieces.groupBy("container").agg(F.sum("tokens").alias("held")).where(F.col("held") > CAPACITY).select("container", F.lit(True).alias("over"))
    n, size = F.count(F.lit(1)), F.sum("tokens")
    # Without gaps and overlaps lengths add up to the end, and squares of ends to those of begins and the last end.
    square = lambda c: (F.col(c) * F.col(c)).cast("decimal(38,0)")
    joined = F.sum(square("to_byte") - square("from_byte")) == F.max(square("to_byte"))
    whole = (F.min("from_byte") == 0) & (F.sum(F.col("to_byte") - F.col("from_byte")) == F.max("to_byte")) & joined & (F.max("part") + 1 == n)
    sound = whole & ((n == 1) | (size > CAPACITY)) & (F.max("tokens") <= CAPACITY) & (F.count("over") == 0)
    return pieces.join(over, "container", "left").groupBy("doc_id").agg(F.sum(F.col("to_byte") - F.col("from_byte")).alias("bytes"), sound.alias("sound"))


def p9_spans(spark: SparkSession, d: str) -> DataFrame:
    found = leaked_passages(table(spark, d, "documents"), table(spark, d, "eval_items"), id="doc_id", text="text", item_id="item_id", item_text="text")
    return found.select(F.col("id").alias("doc_id"), "item_id", F.col("start").alias("start_at"), F.col("end").alias("end_at"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return p9_spans(spark, d).select("doc_id", "item_id").distinct()


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return list_pages(table(spark, d, "documents"), id="doc_id", text="text").select(F.col("id").alias("doc_id"))


QUERIES = {f.__name__: f for f in (p1_found, p2_found, p2_links, p3_found, p3_forms, p4_found, p4_records, p7_found, p7_fused, p8_pack, p8_covered, p9_found, p9_spans, p10_found)}

_GROUPS = """
e AS (SELECT key AS a, peer_key AS b FROM mirror_groups WHERE is_match AND key <> peer_key
      UNION SELECT peer_key, key FROM mirror_groups WHERE is_match AND key <> peer_key),
walk(key, low) AS (SELECT a, a FROM e UNION SELECT e.b, w.low FROM walk w JOIN e ON e.a = w.key),
grp AS (SELECT key, min(low) AS group_key FROM walk GROUP BY key)"""

_SETS = """
n AS (SELECT probe_id, type, lower(trim(x)) AS tok FROM (SELECT probe_id, type, unnest(names) AS x FROM sites_probe WHERE type IS NOT NULL)),
s AS (SELECT DISTINCT probe_id, type, tok FROM n WHERE tok IS NOT NULL AND tok <> ''),
z AS (SELECT probe_id, type, count(*) AS k FROM s GROUP BY ALL HAVING count(*) >= 5),
c AS (SELECT a.probe_id AS probe_a, b.probe_id AS probe_b, count(*) AS common FROM s a JOIN s b ON a.type = b.type AND a.tok = b.tok AND a.probe_id < b.probe_id
      JOIN z za ON za.probe_id = a.probe_id JOIN z zb ON zb.probe_id = b.probe_id GROUP BY ALL),
pairs AS (SELECT probe_a, probe_b FROM c JOIN z za ON za.probe_id = probe_a JOIN z zb ON zb.probe_id = probe_b WHERE common * 10 >= 7 * (za.k + zb.k - common))"""

_PLAIN = "lower(upper(regexp_replace(coalesce({0}, ''), '[^\\p{{L}}\\p{{N}}]+', '', 'g')))"
_FORMS = (
    "r AS (SELECT row_id, "
    + _PLAIN.format("key")
    + " AS k, "
    + _PLAIN.format("name")
    + " AS n, "
    + _PLAIN.format("split_part(api, '?', 1)")
    + " AS b,\n list_sort(list_filter(list_transform(string_split(CASE WHEN contains(api, '?') THEN substr(api, instr(api, '?') + 1) ELSE '' END, '&'), lambda x: "
    + _PLAIN.format("x")
    + "), lambda x: x <> '')) AS q FROM sites WHERE row_id IS NOT NULL),\ng AS (SELECT row_id, min(row_id) OVER w AS first_id FROM r WINDOW w AS (PARTITION BY k, n, b, coalesce(q, [])))"
)


#: What the look-alike SQL knows by itself, apart from the operator's rules and table: full-width forms, spaces, characters
#: without width, radicals that are whole characters, and letters of other scripts with the look of Latin ones.
_WIDE = "".join(map(chr, range(0xFF01, 0xFF5F))), "".join(map(chr, range(0x21, 0x7F)))
_BLANKS = "\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000\t\n\r"
_NO_WIDTH = "\u00ad\u034f\u180e\u200b\u200c\u200d\u200e\u200f\u2060\u2061\u2062\u2063\u2064\ufeff\ufe0e\ufe0f"
_RADICALS = "".join(map(chr, range(0x2F00, 0x2FD6)))
_LETTERS = [("АВЕКМНОРСТХЅІЈ", "ABEKMHOPCTXSIJ"), ("аеорсухіјѕ", "aeopcyxijs"), ("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "ABEZHIKMNOPTYX"), ("ονρα", "ovpa"), ("ԁԛԝһ", "dqwh"), ("‐‑–", "---"), ("’‘", "\'\'"), ("ɡɑıⅼ", "gail"), ("・‧∙⋅•", "·····")]


def _skeleton_form(column: str) -> str:
    from unicodedata import normalize

    source = _WIDE[0] + _BLANKS + _RADICALS + "".join(a for a, _ in _LETTERS) + _NO_WIDTH
    target = _WIDE[1] + " " * len(_BLANKS) + normalize("NFKC", _RADICALS) + "".join(b for _, b in _LETTERS)
    source, target = (x.replace("'", "''") for x in (source, target))
    return f"trim(regexp_replace(nfc_normalize(translate(nfc_normalize({column}), '{source}', '{target}')), ' +', ' ', 'g'))"


_SKELETON_SQL = f"""WITH v AS (SELECT name_id, display_name, {_skeleton_form("display_name")} AS form FROM name_vocab WHERE display_name IS NOT NULL),
      r AS (SELECT 'lives' AS rec_kind, live_id AS rec_id, name FROM lives UNION ALL SELECT 'sites', row_id, name FROM sites),
      f AS (SELECT *, {_skeleton_form("name")} AS form FROM r WHERE name IS NOT NULL AND name NOT IN (SELECT display_name FROM v))
      SELECT rec_kind, rec_id, name_id FROM f JOIN v USING (form) WHERE form <> ''"""

SQL = {
    "p3_found": _SKELETON_SQL,
    "p1_found": f"WITH RECURSIVE {_GROUPS} SELECT key, group_key FROM grp",
    "p2_found": f"WITH {_SETS} SELECT probe_a, probe_b FROM pairs",
    "p2_links": f"""WITH {_SETS}, sig AS (SELECT probe_id, type, list_sort(list(tok)) AS t FROM s JOIN z USING (probe_id, type) GROUP BY ALL),
      cls AS (SELECT probe_id, min(probe_id) OVER (PARTITION BY type, t) AS class_id FROM sig),
      ends AS (SELECT probe_a AS p FROM pairs UNION ALL SELECT probe_b FROM pairs)
      SELECT probe_id, class_id, (SELECT count(*) FROM ends WHERE p = probe_id) AS links FROM cls""",
    "p4_found": f"WITH {_FORMS} SELECT first_id, row_id AS copy_id FROM g WHERE row_id <> first_id",
    "p4_records": f"WITH {_FORMS} SELECT first_id, count(*) AS copies FROM g GROUP BY first_id",
    "p7_found": f"""WITH RECURSIVE {_GROUPS},
      cl AS (SELECT key, level, generated_at FROM mirror_groups UNION ALL SELECT peer_key, peer_level, generated_at FROM mirror_groups),
      lv AS (SELECT key, arg_max(upper(replace(level, ' ', '')), generated_at) AS level FROM cl WHERE level IS NOT NULL AND trim(level) <> '' GROUP BY key),
      ms AS (SELECT key, arg_max(ms, generated_at) AS ms FROM sites_probe WHERE ms IS NOT NULL GROUP BY key),
      nm AS (SELECT key, max(generated_at) AS seen FROM sites_probe WHERE trim(name) <> '' GROUP BY key),
      m AS (SELECT grp.group_key, grp.key, coalesce(list_position(['L3','L2','L1','L?','L0','S1','S0'], level), 8) AS rk, ms, seen
            FROM grp LEFT JOIN lv USING (key) LEFT JOIN ms USING (key) LEFT JOIN nm USING (key))
      SELECT DISTINCT group_key, first_value(key) OVER (PARTITION BY group_key ORDER BY rk, ms NULLS LAST, key) AS keep_key,
             first_value(key) OVER (PARTITION BY group_key ORDER BY seen DESC NULLS LAST, key) AS name_key FROM m""",
    "p8_covered": "SELECT doc_id, strlen(text)::BIGINT AS bytes, true AS sound FROM documents WHERE text <> ''",
    # Runs are stretches of places, one after the other, whose 50 signs are in the item at the same distance.
    "p9_spans": """WITH d AS (SELECT doc_id, text, regexp_replace(lower(text), '[^\\p{L}\\p{N}]+', '', 'g') AS t FROM documents),
      i AS (SELECT item_id, regexp_replace(lower(text), '[^\\p{L}\\p{N}]+', '', 'g') AS t FROM eval_items),
      g AS (SELECT item_id, p AS q, substr(t, p::INT, 50) AS s FROM (SELECT item_id, t, unnest(range(1, length(t) - 48)) AS p FROM i)),
      h AS (SELECT doc_id, p, substr(t, p::INT, 50) AS s FROM (SELECT doc_id, t, unnest(range(1, length(t) - 48)) AS p FROM d)),
      m AS (SELECT doc_id, item_id, p, p - q AS far FROM h JOIN g USING (s)),
      r AS (SELECT doc_id, item_id, min(p) AS a, max(p) + 49 AS z FROM (SELECT *, p - row_number() OVER (PARTITION BY doc_id, item_id, far ORDER BY p) AS isle FROM m) GROUP BY doc_id, item_id, far, isle),
      c AS (SELECT doc_id, list_filter(range(1, length(text) + 1), lambda k: regexp_matches(cs[k], '[\\p{L}\\p{N}]')) AS spot FROM (SELECT doc_id, text, string_split(text, '') AS cs FROM d WHERE doc_id IN (SELECT doc_id FROM m)))
      SELECT doc_id, item_id, (spot[a] - 1)::INT AS start_at, spot[z]::INT AS end_at FROM r JOIN c USING (doc_id)""",
    "p3_forms": f"""WITH r AS (SELECT name FROM lives UNION ALL SELECT name FROM sites), f AS (SELECT name, count(*) AS n FROM r WHERE name IS NOT NULL GROUP BY 1)
      SELECT min(name) AS example, count(*) AS spellings, sum(n)::BIGINT AS rows FROM (SELECT name, n, {_skeleton_form("name")} AS form FROM f) GROUP BY form HAVING count(*) > 1""",
    "p9_found": """WITH d AS (SELECT doc_id, regexp_replace(lower(text), '[^\\p{L}\\p{N}]+', '', 'g') AS t FROM documents),
      i AS (SELECT item_id, regexp_replace(lower(text), '[^\\p{L}\\p{N}]+', '', 'g') AS t FROM eval_items),
      g AS (SELECT DISTINCT item_id, substr(t, p::INT, 50) AS s FROM (SELECT item_id, t, unnest(range(1, length(t) - 48)) AS p FROM i)),
      h AS (SELECT doc_id, substr(t, p::INT, 50) AS s FROM (SELECT doc_id, t, unnest(range(1, length(t) - 48)) AS p FROM d))
      SELECT DISTINCT doc_id, item_id FROM h JOIN g USING (s)""",
}
