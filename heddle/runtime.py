"""Session-level helpers: table loading, durable intermediate tables, size-checked broadcasts, hot-key lookups."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL_DIR: dict[str, str] = {}
_CLEANED: set[str] = set()
_SCOPES: list[list[str]] = []


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A Parquet table of the input folder; column pruning and filters reach its scan."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder for intermediate tables that all executors share.

    It is the session's ``spark.checkpoint.dir``. Only a single-JVM local session may do without that setting and then
    gets a temporary folder; on a cluster its absence is an error, since a machine-local folder would not survive there.
    """
    given = spark.conf.get("spark.checkpoint.dir", None)
    if given:
        return given.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_DIR:
        _LOCAL_DIR[app] = tempfile.mkdtemp(prefix="heddle-")
    return _LOCAL_DIR[app]


def durable(df: DataFrame) -> DataFrame:
    """Writes ``df`` as a table in the shared folder and reads it back, which cuts lineage.

    Unlike cached blocks the files outlive any executor. They go when the application ends, or with a :func:`scratch` block.
    """
    spark = df.sparkSession
    base = f"{shared_dir(spark)}/heddle-{spark.sparkContext.applicationId}"
    path = f"{base}/{uuid.uuid4().hex}"
    for made in _SCOPES:
        made.append(path)
    df.write.parquet(path)
    if base not in _CLEANED:
        _CLEANED.add(base)
        atexit.register(_remove, spark, base)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Drops the intermediate tables made inside the block when it ends; write or collect results before that."""
    made: list[str] = []
    _SCOPES.append(made)
    try:
        yield
    finally:
        _SCOPES[:] = [x for x in _SCOPES if x is not made]
        for path in made:
            _remove(spark, path)


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # the JVM may be gone already
        pass


def broadcast_if_small(df: DataFrame, max_rows: int = 100_000, max_bytes: int = 64 << 20) -> DataFrame:
    """``df`` with a broadcast hint if it is proved to hold at most ``max_rows`` rows and ``max_bytes`` of strings.

    Beyond that it comes back unhinted, and the join shuffles.
    """
    width = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c, t in df.dtypes if t == "string"), F.lit(8 * len(df.columns)))
    n, size = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    return F.broadcast(df) if n <= max_rows and size <= max_bytes else df


def hot_lookup(big: DataFrame, small: DataFrame, key: list[str], weight: str, most_hot: int = 1000, at_least: int = 100_000) -> DataFrame:
    """Left join of ``big`` to ``small`` on ``key`` (unique in ``small``), with hot keys split off.

    ``weight`` is a column of ``small`` with the number of rows of ``big`` for that key. Keys above
    ``max(at_least, total / most_hot)`` are at most ``most_hot`` by construction; they are broadcast, so their rows stay
    where they are, and all others are shuffled. ``big`` should be cheap to scan twice. Null keys match null keys.
    """
    total = small.agg(F.coalesce(F.sum(weight), F.lit(0))).first()[0]
    line = max(at_least, -(-int(total) // most_hot))
    hot = small.where(F.col(weight) > line)
    n_hot = hot.count()
    rest = small.where(F.col(weight) <= line)
    if not n_hot:
        return _join(big, rest, key, "left")
    hot_keys = F.broadcast(hot.select(*key))
    return _join(big, F.broadcast(hot), key, "inner").unionByName(_join(_join(big, hot_keys, key, "left_anti"), rest, key, "left"))


def _join(a: DataFrame, b: DataFrame, key: list[str], how: str) -> DataFrame:
    right = b.select(*[F.col(k).alias(f"__{k}") for k in key], *[c for c in b.columns if c not in key])
    on = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in key]
    return a.join(right, on, how).drop(*[f"__{k}" for k in key])
