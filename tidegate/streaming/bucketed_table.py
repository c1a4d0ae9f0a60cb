"""A keyed table in hash buckets, whose versions are manifests.

Rows lie in a fixed number of buckets by a hash of their key. An upsert reads and writes the buckets
that its batch has keys of, each into a new folder, and leaves the others where they are. Then it writes a
manifest, a small file that names the folder of every bucket, under a temporary name and renames it; the newest
manifest is the table. A crash before that leaves the version before as it was, and what was written is
removed later. One writer at a time: a second one that commits the same version fails.

Layout: `<table>/data/<write>/__bucket=<n>/` and `<table>/manifest/<version>.json`.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.operators.skew import null_safe_key
from tidegate.session import delete_path

#: Rows of the first batch for each bucket, where the number of buckets is not given, and the least and most of them.
ROWS_PER_BUCKET, LEAST_BUCKETS, MOST_BUCKETS = 250_000, 8, 4_096
_BUCKET = "__bucket"


@dataclass(frozen=True)
class Version:
    """What a manifest says: the folder of each bucket that has rows, and the name and number of the batch that made it."""

    number: int
    buckets: int
    keys: list[str]
    schema: str
    batch: str = ""
    stamp: int | None = None
    folders: dict[str, str] = field(default_factory=dict)


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """Bucket number of a key: 32 bits of the md5 of its fields as JSON, in which null fields are absent."""
    return (F.conv(F.substring(F.md5(F.to_json(null_safe_key(keys))), 1, 8), 16, 10).cast("bigint") % buckets).cast("int")


def _folder(spark: SparkSession, path: str):
    """A path and its file system."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def _names(spark: SparkSession, path: str) -> list[str]:
    place, fs = _folder(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(place)] if fs.exists(place) else []


def versions(spark: SparkSession, table: str) -> list[int]:
    """Numbers of the versions, in order."""
    stems = [n.removesuffix(".json") for n in _names(spark, f"{table}/manifest") if n.endswith(".json")]
    return sorted(int(n) for n in stems if n.isdigit())


def version(spark: SparkSession, table: str, number: int | None = None) -> Version | None:
    """A version, by default the newest; None while there is none."""
    complete = versions(spark, table)
    if not complete:
        return None
    chosen = complete[-1] if number is None else number
    if chosen not in complete:
        raise ValueError(f"there is no version {chosen}")
    place, fs = _folder(spark, f"{table}/manifest/{chosen}.json")
    file = fs.open(place)
    try:
        return Version(**json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(file, "UTF-8")))
    finally:
        file.close()


def read_version(spark: SparkSession, table: str, number: int | None = None, buckets: Sequence[int] | None = None) -> DataFrame:
    """The rows of a version, of some buckets only where they are named; other folders are not listed."""
    own = version(spark, table, number)
    if own is None:
        raise ValueError(f"{table} has no version")
    return _rows(spark, table, own, buckets)


def _rows(spark: SparkSession, table: str, own: Version, buckets: Sequence[int] | None) -> DataFrame:
    wanted = own.folders if buckets is None else {str(b): own.folders[str(b)] for b in buckets if str(b) in own.folders}
    schema = T.StructType.fromJson(json.loads(own.schema))
    if not wanted:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{table}/{folder}" for folder in wanted.values()])


def rewrite_buckets(
    batch: DataFrame, table: str, keys: Sequence[str], merge, buckets: int | None = None, batch_name: str = "",
    stamp: int | None = None, keep: int = 2,
) -> Version:
    """A new version in which the buckets that `batch` has keys of hold what `merge(batch, their rows)` returns.

    The number of buckets and the keys are those of the table once it exists; a new table's number follows the
    rows of its first batch unless it is given. A batch whose name made the newest
    version is not applied again; `stamp` is a number that the manifest keeps for readers. Of older versions the last `keep` (this one included) stay readable.
    """
    spark = batch.sparkSession
    old = version(spark, table)
    if old is None:
        buckets = buckets or max(LEAST_BUCKETS, min(MOST_BUCKETS, batch.count() // ROWS_PER_BUCKET))
        old = Version(-1, buckets, list(keys), batch.schema.json())
    elif old.keys != list(keys):
        raise ValueError(f"the table is kept by {old.keys}")
    elif batch_name and old.batch == batch_name:
        return old
    # One number for each bucket at most.
    touched = sorted(r[0] for r in batch.select(bucket_of(keys, old.buckets).alias("b")).distinct().collect())
    rows = merge(batch, _rows(spark, table, old, touched))
    write = f"data/{uuid.uuid4().hex}"
    placed = rows.withColumn(_BUCKET, bucket_of(keys, old.buckets)).hint("rebalance", _BUCKET)
    placed.write.option("partitionOverwriteMode", "static").partitionBy(_BUCKET).parquet(f"{table}/{write}")
    made = {n.removeprefix(f"{_BUCKET}="): f"{write}/{n}" for n in _names(spark, f"{table}/{write}") if n.startswith(_BUCKET)}
    kept = {b: f for b, f in old.folders.items() if int(b) not in touched}
    new = replace(old, number=old.number + 1, schema=rows.schema.json(), batch=batch_name, stamp=stamp, folders=kept | made)
    commit(spark, table, new)
    clean(spark, table, keep)
    return new


def commit(spark: SparkSession, table: str, new: Version) -> None:
    """Write the manifest under a temporary name and give it its number, which must be free."""
    hidden, fs = _folder(spark, f"{table}/manifest/.{uuid.uuid4().hex}")
    goal, _ = _folder(spark, f"{table}/manifest/{new.number}.json")
    out = fs.create(hidden, False)
    try:
        out.write(bytearray(json.dumps(asdict(new)), "utf-8"))
    finally:
        out.close()
    if fs.exists(goal) or not fs.rename(hidden, goal):
        fs.delete(hidden, False)
        raise RuntimeError(f"version {new.number} was written by another writer")


def clean(spark: SparkSession, table: str, keep: int) -> None:
    """Remove all but the last `keep` versions, and every bucket folder that none of those names."""
    complete = versions(spark, table)
    kept = {f for n in complete[-keep:] for f in version(spark, table, n).folders.values()}
    gone = {f for n in complete[:-keep] for f in version(spark, table, n).folders.values()} - kept
    writes = {f.rpartition("/")[0] for f in kept}
    for folder in gone:
        if folder.rpartition("/")[0] in writes:
            delete_path(spark, f"{table}/{folder}")
    for write in _names(spark, f"{table}/data"):  # of dropped versions, and of attempts that never were one
        if f"data/{write}" not in writes:
            delete_path(spark, f"{table}/data/{write}")
    for number in complete[:-keep]:
        delete_path(spark, f"{table}/manifest/{number}.json")
