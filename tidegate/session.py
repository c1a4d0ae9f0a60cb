"""Session set-up, the shared folder, and intermediate tables stored in it."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(app: str = "tidegate", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators expect; `conf` keys use `__` for dots."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by `spark.checkpoint.dir`.

    Where it is unset, a `local` or `local[n]` master uses a folder below the warehouse, which all its tasks share.
    Everywhere else the setting is required.
    """
    configured = spark.conf.get(CHECKPOINT_CONF, None)
    if configured:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(configured)
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError(f"{CHECKPOINT_CONF} must name a shared folder on a cluster")
    own = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_tidegate"
    spark.sparkContext.setCheckpointDir(own)
    spark.conf.set(CHECKPOINT_CONF, own)
    return own


_WORKSPACES: ContextVar[tuple[str, ...]] = ContextVar("workspaces", default=())


@contextmanager
def workspace(spark: SparkSession) -> Iterator[str]:
    """A scope for intermediate tables: all that operators store within it is deleted at its end.

    Results that still read such tables must be written or collected inside the scope.
    """
    folder = f"{shared_dir(spark)}/scratch/{uuid.uuid4().hex}"
    token = _WORKSPACES.set((*_WORKSPACES.get(), folder))
    try:
        yield folder
    finally:
        _WORKSPACES.reset(token)
        delete_path(spark, folder)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder of any file system that Spark reads."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def folders_of(spark: SparkSession, path: str) -> dict[str, bool]:
    """Names of the folders below `path`, each with whether a finished write marked it as complete."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    top = hadoop.Path(path)
    fs = top.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(top):
        return {}
    listed = [s.getPath() for s in fs.listStatus(top) if s.isDirectory()]
    return {p.getName(): fs.exists(hadoop.Path(p, "_SUCCESS")) for p in listed}


def scratch_path(spark: SparkSession, name: str, outer: bool = False) -> str:
    """A fresh path below the open workspace (with `outer` the one around it), or else below the shared folder."""
    open_folders = _WORKSPACES.get()[:-1] if outer else _WORKSPACES.get()
    top = open_folders[-1] if open_folders else f"{shared_dir(spark)}/scratch"
    return f"{top}/{uuid.uuid4().hex}/{name}"


def store(df: DataFrame, name: str, outer: bool = False) -> DataFrame:
    """Write `df` as Parquet to the shared folder and read it back: lineage is cut, executors may go.

    With `outer` it outlives the open workspace: a block of work keeps its result and drops its intermediates.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name, outer)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


ROWS_PER_BUCKET = 250_000


@contextmanager
def bucketed(df: DataFrame, columns: Sequence[str], rows: int) -> Iterator[DataFrame]:
    """`df` of about `rows` rows, stored in the shared folder and bucketed by `columns`.

    Joins on these columns read the buckets without another shuffle. The number of buckets follows
    the rows alone. The catalog entry lives as long as the context, so use it for data that later
    steps materialise.
    """
    spark = df.sparkSession
    n = max(1, rows // ROWS_PER_BUCKET)
    name = f"tidegate_{uuid.uuid4().hex}"
    stored = df.repartition(n, *columns).write.bucketBy(n, *columns).format("parquet")
    stored.option("path", scratch_path(spark, name)).saveAsTable(name)
    try:
        yield spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def discard(stored: DataFrame) -> None:
    """Delete what `store` wrote for this frame, once nothing reads it any more."""
    files = stored.inputFiles()
    if files:
        delete_path(stored.sparkSession, files[0].rpartition("/")[0])


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package where the job was not submitted with it.

    Nothing is sent if the workers find it by themselves: through PYTHONPATH or the working folder.
    """
    root = Path(__file__).resolve().parent.parent
    found = [*os.environ.get("PYTHONPATH", "").split(os.pathsep), os.getcwd()]
    if any(p and Path(p).resolve() == root for p in found) or getattr(spark.sparkContext, "_tidegate_shipped", False):
        return
    archive = Path(tempfile.mkdtemp(prefix="tidegate-")) / "tidegate.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted((root / "tidegate").rglob("*.py")):
            out.write(file, file.relative_to(root))
    spark.sparkContext.addPyFile(str(archive))
    spark.sparkContext._tidegate_shipped = True


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise `df` in the shared folder, so that lost executors lose no work."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
