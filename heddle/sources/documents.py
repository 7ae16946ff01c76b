"""Tolerant readers and idempotent writers of JSON documents, line files, inventories and registries."""

from __future__ import annotations

import base64
import gzip
import json
import re
import struct
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heddle.functions.content import magic_kind


def exists(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(where)
    return found is not None and len(found) > 0


def load_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A JSON document; a missing or corrupt one gives no rows."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    texts = spark.read.text(path, wholetext=True).where(F.try_parse_json("value").isNotNull())
    # One object, or an array of them.
    many = F.when(F.col("value").rlike(r"^\s*\["), F.from_json("value", f"array<struct<{schema}>>")).otherwise(F.array(F.from_json("value", schema)))
    return texts.select(F.explode(many).alias("r")).select("r.*")


def load_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A file of JSON lines without its bad lines."""
    return spark.read.schema(schema).json(path, mode="DROPMALFORMED") if exists(spark, path) else spark.createDataFrame([], schema)


def last_per_key(spark: SparkSession, path: str, schema: str, key: str) -> DataFrame:
    """The last line of each key, by file, place in it and content."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"), F.monotonically_increasing_id().alias("n"))
    rows = lines.withColumn("r", F.from_json("value", schema, {"mode": "PERMISSIVE"})).where(F.col(f"r.{key}").isNotNull())
    return rows.groupBy(F.col(f"r.{key}").alias("__k")).agg(F.max_by("r", F.struct("f", "b", "n")).alias("r")).select("r.*")


def inventory(spark: SparkSession, path: str, content: bool = False) -> DataFrame:
    """(path, length, modificationTime): files below a folder. With ``content``, which reads them, also (kind, md5, sha1, sha256)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    read = [magic_kind(F.substring("content", 1, 512)).alias("kind"), F.md5("content").alias("md5"), F.sha1("content").alias("sha1"), F.sha2("content", 256).alias("sha256")]
    return files.select("path", "length", "modificationTime", *(read if content else []))


def upsert_registry(registry: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Rows of ``changes`` replace those of the same key; others stay."""
    return changes.unionByName(registry.join(changes.select(key), key, "left_anti"))


_LAYER = re.compile(rb"^\s*[A-Za-z0-9]*\*\*([A-Za-z0-9+/=\s]+)$")


def decode_layers(data: bytes | None, most_depth: int = 4, most_bytes: int = 256 << 20) -> bytes | None:
    """Peels prefix-** base64, gzip and bare base64 off a document; plain text passes, and so does what is below the last layer.

    A document that grows over ``most_bytes`` is an error, not a result: it would come out encoded and look whole.
    """
    for _ in range(most_depth):
        if data is None:
            return None
        if len(data) > most_bytes:
            raise ValueError(f"a document of over {most_bytes} bytes")
        if data[:2] == b"\x1f\x8b":
            try:
                data = gzip.decompress(data)
                continue
            except (OSError, EOFError):
                return data
        m = _LAYER.match(data)
        body = m.group(1) if m else data if re.fullmatch(rb"[A-Za-z0-9+/\s]{16,}={0,2}\s*", data) and len(re.sub(rb"\s", b"", data)) % 4 == 0 else None
        if body is None:
            return data
        try:
            data = base64.b64decode(re.sub(rb"\s", b"", body), validate=True)
        except ValueError:
            return data
    return data


def decoded(df: DataFrame, column: str, name: str, most_bytes: int = 256 << 20) -> DataFrame:
    """Adds the decoded content of a binary column, and ``<name>_error``: why a document has none.

    Arrow batches, since no built-in inflates gzip."""

    def one(data: bytes | None) -> tuple[bytes | None, str | None]:
        try:
            return decode_layers(data, most_bytes=most_bytes), None
        except ValueError as e:
            return None, str(e)

    @F.pandas_udf("content binary, error string")
    def run(s: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([one(x) for x in s], columns=["content", "error"], dtype=object)

    made = df.withColumn("__d", run(F.col(column).cast("binary")))
    return made.withColumn(name, F.col("__d.content")).withColumn(f"{name}_error", F.col("__d.error")).drop("__d")


def requestable_hosts(df: DataFrame, column: str, name: str) -> DataFrame:
    """Adds the address with its host in ASCII (IDNA); port, path and existing escapes stay, hopeless hosts too."""

    def one(u: str) -> str:
        m = re.match(r"(?s)^([A-Za-z][A-Za-z0-9+.\-]*://)([^/:?#]+)(.*)$", u)
        if not m or m.group(2).isascii():
            return u
        try:
            return m.group(1) + m.group(2).encode("idna").decode() + m.group(3)
        except UnicodeError:
            return u

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(one, na_action="ignore")

    return df.withColumn(name, run(F.col(column)))


def json_urls(df: DataFrame, *, id: str, column: str) -> DataFrame:
    """(id, json_path, url) for every address in a JSON document of any shape; unparsable ones give none."""

    def walk(v: object, path: str) -> Iterator[tuple[str, str]]:
        stack = [(v, path)]
        while stack:
            x, p = stack.pop()
            if isinstance(x, dict):
                stack += [(y, f"{p}.{k}") for k, y in reversed(x.items())]
            elif isinstance(x, list):
                stack += [(y, f"{p}[{i}]") for i, y in reversed(list(enumerate(x)))]
            elif isinstance(x, str) and re.match(r"^https?://", x):
                yield p, x

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for i, text in zip(b["id"], b["t"]):
                try:
                    out += [(i, p, u) for p, u in walk(json.loads(text or "null"), "$")]
                except ValueError:
                    continue
            yield pd.DataFrame(out, columns=["id", "json_path", "url"])

    kind = dict(df.dtypes)[id]
    return df.select(F.col(id).alias("id"), F.col(column).alias("t")).where(F.col("id").isNotNull() & F.col("t").isNotNull()).mapInPandas(run, f"id {kind}, json_path string, url string")


def strip_private(df: DataFrame) -> DataFrame:
    """Without fields whose name begins with an underscore, at any depth of structs and arrays of structs."""
    from pyspark.sql import types as T

    def keep(c, t):
        if isinstance(t, T.StructType):
            return F.struct(*[keep(c[f.name], f.dataType).alias(f.name) for f in t.fields if not f.name.startswith("_")])
        if isinstance(t, T.ArrayType) and isinstance(t.elementType, T.StructType):
            return F.transform(c, lambda x: keep(x, t.elementType))
        return c

    return df.select(*[keep(F.col(f.name), f.dataType).alias(f.name) for f in df.schema.fields if not f.name.startswith("_")])


def rewrite_references(c, pairs: list[tuple[str, str]]):
    """Replaces paths in a text, the longest first so that no path is cut by a shorter one."""
    for old, new in sorted(pairs, key=lambda p: (-len(p[0]), p[0])):
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def write_version(df: DataFrame, folder: str, version: str, partition: list[str] | None = None) -> str:
    """Writes a new version beside the old ones and returns its path; an input that is being read is never overwritten."""
    path = f"{folder}/version={version}"
    w = df.write.mode("overwrite")
    (w.partitionBy(*partition) if partition else w).parquet(path)
    return path


def replace_json(df: DataFrame, path: str) -> str:
    """Replaces a folder of JSON lines: the new one is written beside it and renamed into its place once it is complete.

    A reader sees the old content or the new, and an input that is being read is not overwritten while it is read.
    """
    spark = df.sparkSession
    Path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    here, made, old = Path(path), Path(f"{path}.new-{uuid.uuid4().hex}"), Path(f"{path}.old-{uuid.uuid4().hex}")
    df.write.option("ignoreNullFields", "false").json(str(made))
    fs = here.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(here):
        fs.rename(here, old)
    if not fs.rename(made, here):
        raise OSError(f"cannot rename to {path}")
    if fs.exists(old):
        fs.delete(old, True)
    return path


def rule_documents(vocab: DataFrame, *, document: str, key: str, value: str) -> DataFrame:
    """(document, json): one JSON object a document, its keys sorted, each with its sorted distinct values.

    The same rules give the same bytes, so writing them again changes nothing. A vocabulary is small by its meaning; the values
    of a key are made distinct before they are brought together.
    """
    lists = vocab.where(F.col(document).isNotNull() & F.col(key).isNotNull() & F.col(value).isNotNull()).select(document, key, value).distinct()
    lists = lists.groupBy(document, key).agg(F.array_sort(F.collect_set(value)).alias("v"))
    doc = lists.groupBy(document).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(key, "v")))).alias("m"))
    return doc.select(F.col(document).alias("document"), F.to_json("m").alias("json"))


def write_rules(rules: DataFrame, folder: str) -> None:
    """Writes each document of :func:`rule_documents` under ``folder`` as document=<name>; only those given are replaced."""
    w = rules.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("document")
    w.text(folder)


def markdown_table(df: DataFrame, most: int = 200) -> str:
    """A small result as a Markdown table of at most ``most`` rows; how many rows are left out stands below it."""
    rows, more = _first_rows(df, most)
    head = "| " + " | ".join(df.columns) + " |\n|" + " --- |" * len(df.columns)
    return head + "".join("\n| " + " | ".join("" if v is None else str(v).replace("|", "\\|") for v in r) + " |" for r in rows) + "\n" + (f"\n{more} more rows\n" if more else "")


def _first_rows(df: DataFrame, most: int) -> tuple[list, int]:
    rows = df.limit(most + 1).collect()
    return rows[:most], df.count() - most if len(rows) > most else 0


def append_jsonl(df: DataFrame, path: str) -> None:
    """Appends rows as JSON lines."""
    df.write.mode("append").json(path)


def html_table(df: DataFrame, title: str, most: int = 500) -> str:
    """A small result as an HTML page of at most ``most`` rows; how many rows are left out stands below the table."""
    from html import escape

    rows, more = _first_rows(df, most)
    cells = lambda tag, values: "<tr>" + "".join(f"<{tag}>{escape('' if v is None else str(v))}</{tag}>" for v in values) + "</tr>"
    return f"<!DOCTYPE html><title>{escape(title)}</title><table>{cells('th', df.columns)}{''.join(cells('td', r) for r in rows)}</table>" + (f"<p>{more} more rows</p>" if more else "")


def export_subsets(df: DataFrame, folder: str, by: list[str]) -> None:
    """One folder of Parquet files for each value of ``by``; rows of one value come from many tasks."""
    df.write.mode("overwrite").partitionBy(*by).parquet(folder)


def read_nul_list(spark: SparkSession, path: str) -> DataFrame:
    """(path) entries of a list separated by NUL, as version control prints them; names are UTF-8."""
    return spark.read.text(path, lineSep="\0").select(F.col("value").alias("path")).where(F.length("path") > 0)


def archive_entries(df: DataFrame, *, path: str, content: str) -> DataFrame:
    """(path, error, entries): the names in a zip archive; an unreadable one has an error and a null list, never an empty one."""
    import io
    import zipfile

    def one(b: bytes | None) -> tuple[str | None, list[str] | None]:
        try:
            with zipfile.ZipFile(io.BytesIO(b or b"")) as z:
                return None, sorted(z.namelist())
        except (zipfile.BadZipFile, ValueError, OSError) as e:
            return type(e).__name__, None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = [one(x) for x in b["c"]]
            yield pd.DataFrame({"path": b["path"], "error": [e for e, _ in got], "entries": [n for _, n in got]})

    return df.select(F.col(path).alias("path"), F.col(content).alias("c")).mapInPandas(run, "path string, error string, entries array<string>")


def _dex_classes(b: bytes) -> set[str]:
    """The names, without their packages, of the classes that a .dex file defines."""
    if b[:4] != b"dex\n":
        raise ValueError("not a dex file")
    n_strings, strings_at, n_types, types_at = struct.unpack_from("<4I", b, 0x38)
    n_classes, classes_at = struct.unpack_from("<2I", b, 0x60)
    strings, types = struct.unpack_from(f"<{n_strings}I", b, strings_at), struct.unpack_from(f"<{n_types}I", b, types_at)
    names = set()
    for i in range(n_classes):
        at = strings[types[struct.unpack_from("<I", b, classes_at + 32 * i)[0]]]
        while b[at] & 0x80:  # the length before the string, seven bits a byte
            at += 1
        m = re.fullmatch("L([^']+);", b[at + 1 : b.index(0, at + 1)].decode("utf-8", "replace"))
        if m:
            names.add(m.group(1).split("/")[-1])
    return names


def dex_classes(df: DataFrame, *, path: str, content: str) -> DataFrame:
    """(path, err, classes): the classes in the .dex entries of a zip archive; if none can be read, an error and a null list,
    never an empty one."""
    import io
    import zipfile
    import zlib

    def one(b: bytes | None) -> tuple[str | None, list[str] | None]:
        try:
            with zipfile.ZipFile(io.BytesIO(b or b"")) as z:
                dexes = [z.read(n) for n in z.namelist() if n.endswith(".dex")]
        except (zipfile.BadZipFile, zlib.error, RuntimeError, ValueError, OSError, EOFError) as e:
            return f"zip:{str(e)[:100]}", None
        if not dexes:
            return "no-dex-entry", None
        found = set()
        for d in dexes:
            try:
                found |= _dex_classes(d)
            except (struct.error, IndexError, ValueError):
                continue
        return (None, sorted(found)) if found else ("dex-parsed-nothing", None)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = [one(x) for x in b["c"]]
            yield pd.DataFrame({"path": b["path"], "err": [e for e, _ in got], "classes": [n for _, n in got]})

    return df.select(F.col(path).alias("path"), F.col(content).alias("c")).mapInPandas(run, "path string, err string, classes array<string>")
