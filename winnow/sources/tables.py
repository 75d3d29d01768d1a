"""Versioned Parquet tables: every stage writes a new directory, none is overwritten
while it is read. A directory counts once its write has been committed. Rows that are only
added land in batches beside the newest version, and the next one takes them in.

A table with a key is partitioned into buckets of its hash. An update then writes the buckets with a
changed row alone, ``u=N`` beside the whole versions ``v=N``, and a bucket is read where it was
written last; an insert looks up its keys in their buckets and reads no other."""

from __future__ import annotations

import re
from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Where ``spark.checkpoint.dir`` is unset, as in tests, a session names its folder here.
SHARED_DIR = "winnow.shared.dir"


def shared_dir(spark: SparkSession) -> str:
    """A new folder below the one the cluster shares (``spark.checkpoint.dir``)."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(SHARED_DIR, None)
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{root.rstrip('/')}/{uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """Write a table to the shared folder and read it back: its size is known, its lineage cut."""
    path = shared_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Buckets of a new table; ``run_compaction`` deals an old one anew. Choose them so that one holds a GB or so.
BUCKETS = 16
BUCKET = "bucket"


def bucket_of(key: Column, n: int) -> Column:
    """Name of a key's bucket, one of ``n``; it tells the number of buckets as well."""
    return F.concat(F.pmod(F.xxhash64(key), F.lit(n)).cast("string"), F.lit(f"-{n}"))


def buckets_of(keys: DataFrame, key: str, n: int) -> list[str]:
    """The buckets that hold any of the keys: ``n`` names at most come to the driver."""
    return sorted(r[0] for r in keys.select(bucket_of(F.col(key), n)).distinct().collect())


@dataclass(frozen=True)
class Bucket:
    folder: str  # of the version or update
    folded: int


@dataclass(frozen=True)
class Version:
    """What a reader sees: a committed version, 0 if there is none, and the batches landed since."""

    number: int = 0
    path: str | None = None  # of the newest whole version
    folded: int = 0  # batches up to this number are part of the whole version
    batches: Mapping[int, str] = field(default_factory=dict)
    dealt: Collection[int] = ()  # those of the batches that lie in buckets
    buckets: Mapping[str, Bucket] = field(default_factory=dict)  # where each was written last, if there are any

    @property
    def last_batch(self) -> int:
        return max([self.folded, *self.batches, *(b.folded for b in self.buckets.values())])

    @property
    def n_buckets(self) -> int:
        """Into how many buckets keys are dealt."""
        return int(next(iter(self.buckets)).split("-")[1]) if self.buckets else BUCKETS


def children(spark: SparkSession, root: str) -> list[tuple[str, str]]:
    """Names and paths of what is in a folder, if there is one."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = fs.listStatus(path) if fs.exists(path) else ()
    return [(s.getPath().getName(), s.getPath().toString()) for s in found]


def _numbered(spark: SparkSession, root: str) -> tuple[dict[tuple[int, int, str], str], dict[int, str]]:
    """Paths of the versions, by number, last batch in them and sort, and of the batches, by number."""
    versions, batches = {}, {}
    for name, at in children(spark, root):
        if m := re.fullmatch(r"([uv])=(\d+)(?:\.b(\d+))?", name):
            versions[int(m[2]), int(m[3] or 0), m[1]] = at
        elif m := re.fullmatch(r"batch=(\d+)", name):
            batches[int(m[1])] = at
    return versions, batches


def _bucket_names(spark: SparkSession, folder: str) -> list[str]:
    return [name.removeprefix(f"{BUCKET}=") for name, _ in children(spark, folder) if name.startswith(f"{BUCKET}=")]


def _is_committed(spark: SparkSession, path: str) -> bool:
    done = spark._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    return done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done)


def newest(spark: SparkSession, root: str) -> Version:
    """The newest committed version, the buckets written since, and the committed batches that are not part of it.

    Looks into whole versions and updates from the last one back to a whole one, at their folders' names alone.
    """
    versions, batches = _numbered(spark, root)
    number, folded, path, buckets = 0, 0, None, {}
    for (n, b, kind), at in sorted(versions.items(), reverse=True):
        if not _is_committed(spark, at):
            continue
        number = number or n
        for name in _bucket_names(spark, at):
            buckets.setdefault(name, Bucket(at, b))
        if kind == "v":
            folded, path = b, at
            break
    since = {n: at for n, at in sorted(batches.items()) if n > folded and _is_committed(spark, at)}
    return Version(number, path, folded, since, {n for n, at in since.items() if _bucket_names(spark, at)}, buckets)


def _landed(
    spark: SparkSession, version: Version, root: str, schema: T.StructType, wanted: Collection[str] | None, key: str
) -> list[DataFrame]:
    """Rows of the batches that their bucket has not yet taken in."""
    groups: dict[tuple[bool, frozenset[str]], list[str]] = {}
    for number, path in version.batches.items():
        done = frozenset(b for b, at in version.buckets.items() if at.folded >= number)
        groups.setdefault((number in version.dealt, done), []).append(path)
    out = []
    for (dealt, done), paths in groups.items():
        rows = _read(spark, root, schema, paths) if dealt else spark.read.schema(schema).parquet(*paths)
        if not version.buckets:
            out.append(rows)
            continue
        n = version.n_buckets
        own, at = bucket_of(F.col(key), n), F.col(BUCKET) if dealt else F.lit(None).cast("string")
        # The partition's name prunes; a batch that was dealt into another number of buckets is read whole.
        other = at.isNull() | ~F.endswith(at, F.lit(f"-{n}"))
        if done:
            rows = rows.where(other | ~at.isin(*done)).where(~own.isin(*done))
        if wanted is not None:
            rows = rows.where(other | at.isin(*wanted)).where(own.isin(*wanted))
        out.append(rows)
    return out


def _read(spark: SparkSession, base: str, schema: T.StructType, paths: Collection[str]) -> DataFrame:
    """Rows of some of the folders below ``base``, and their bucket."""
    whole = T.StructType([*schema.fields, T.StructField(BUCKET, T.StringType())])
    return spark.read.schema(whole).option("basePath", base).parquet(*paths)


def read_version(
    spark: SparkSession, version: Version, schema: T.StructType, defaults=None, buckets: Collection[str] | None = None, key: str = "id"
) -> DataFrame:
    """Rows of a version and of the batches landed since; an empty table if there are none.

    Columns that the files of an older table lack, or hold no value for, get their ``defaults``. With
    ``buckets`` only the rows of those are read; a table without buckets is read whole all the same.
    """
    root = next(iter(version.batches.values()), "").rpartition("/")[0]
    found = _landed(spark, version, root, schema, buckets, key)
    folders: dict[str, list[str]] = {}
    for name, bucket in version.buckets.items():
        if buckets is None or name in buckets:
            folders.setdefault(bucket.folder, []).append(f"{bucket.folder}/{BUCKET}={name}")
    found += [_read(spark, folder, schema, paths) for folder, paths in folders.items()]
    if version.path and not version.buckets:
        found.append(spark.read.schema(schema).parquet(version.path))
    if not found:
        return spark.createDataFrame([], schema)
    defaults = defaults or {}
    columns = [
        F.coalesce(F.col(n), F.lit(defaults[n])).alias(n) if n in defaults else F.col(n)
        for n in schema.names
    ]
    return reduce(DataFrame.unionByName, [rows.select(*columns) for rows in found])


def read_latest(spark: SparkSession, root: str, schema: T.StructType, defaults=None) -> DataFrame:
    return read_version(spark, newest(spark, root), schema, defaults)


def next_version(spark: SparkSession, root: str) -> int:
    return newest(spark, root).number + 1


def _dealt(df: DataFrame, key: str, n: int) -> DataFrame:
    """Rows with their bucket, brought together by it; Spark splits a large one over several tasks."""
    return df.withColumn(BUCKET, bucket_of(F.col(key), n)).hint("rebalance", BUCKET)


def write_next(
    df: DataFrame,
    root: str,
    partition_by: Sequence[str] = (),
    seen: Version | None = None,
    key: str | None = None,
    only: Collection[str] | None = None,
    buckets: int | None = None,
) -> tuple[int, str]:
    """Write the next version; returns its number and path. One writer of versions at a time.

    ``seen`` is the version that ``df`` was made from: batches that were part of it then are part of the
    next one, those that landed meanwhile still count beside it. Without ``seen`` all batches do.
    With a ``key`` rows are dealt into its buckets. ``only`` names the buckets that ``df`` holds
    all rows of: they are written, the others stay where they are. ``buckets`` sets their number for a whole version.
    """
    spark = df.sparkSession
    at = seen or newest(spark, root)
    folded, number = (at.last_batch if seen else at.folded), at.number + 1
    path = f"{root}/{'v' if only is None else 'u'}={number}" + (f".b{folded}" if folded else "")
    if key:
        df, partition_by = _dealt(df, key, buckets or at.n_buckets), (BUCKET, *partition_by)
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return number, path


def land(df: DataFrame, root: str, key: str | None = None, buckets: int = BUCKETS) -> str:
    """Add rows beside the newest version, at the cost of those rows alone; returns their path.

    For rows that are inserted only if absent: once they are committed a second run finds them, and what
    a run that was cut off left behind is never read. One writer of batches at a time; a second one of
    the same number fails. Versions may be written meanwhile. With a ``key`` rows are dealt into buckets.
    """
    versions, batches = _numbered(df.sparkSession, root)
    last = max([0, *batches, *(b for _, b, _ in versions)])
    path = f"{root}/batch={last + 1}"
    (_dealt(df, key, buckets).write.partitionBy(BUCKET) if key else df.write).parquet(path)
    return path
