"""Session settings and the shared work folder."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# Everything here can be overridden by the cluster's own configuration.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot key is split even where the join feeds an aggregate on the same key.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # A log is filtered at its scan by the stored list of wanted queries, up to some two million of them:
    # beyond that a filter of Spark's size, a megabyte, would let most other rows pass.
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "32MB",
    # Python batches are bounded by bytes too: one parse tree may be large.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 * 1024 * 1024),
    # Many paths are listed by some hundred tasks: Spark's own number is a task for each of up to 10 000,
    # which the stream of landing files would pay again with every batch.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "256",
}
TUNED = [
    "spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled",
    "spark.sql.adaptive.forceOptimizeSkewedJoin", "spark.sql.execution.arrow.maxBytesPerBatch",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold",
    "spark.sql.sources.parallelPartitionDiscovery.parallelism",
]


def build_session(app: str = "querytrail", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings above; pass further or other settings with **{"spark.x": "y"}."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Skew handling and batch limits where a session that was started elsewhere leaves them unset."""
    given = {key for key, _ in spark.sparkContext.getConf().getAll()}
    for key in TUNED:
        if key not in given:
            spark.conf.set(key, DEFAULTS[key])
    return spark


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the workers, once per application; they need not have it installed."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        _SHIPPED.add(context.applicationId)
        package = Path(__file__).resolve().parent
        folder = tempfile.mkdtemp(prefix="querytrail-code-")
        archive = shutil.make_archive(f"{folder}/querytrail", "zip", package.parent, package.name)
        context.addPyFile(archive)
    return spark


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A new path under the shared folder that the cluster names in spark.checkpoint.dir."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        current = spark.sparkContext.getCheckpointDir()
        if current is None:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            current = tempfile.mkdtemp(prefix="querytrail-")
            spark.sparkContext.setCheckpointDir(current)
        base = current
    path = f"{base.rstrip('/')}/querytrail-{purpose}-{uuid.uuid4().hex}"
    for made in _OPEN:
        made.append(path)
    return path


_OPEN: list[list[str]] = []


@contextmanager
def cleaned_up(spark: SparkSession) -> Iterator[None]:
    """Remove on leaving what was stored in the shared folder meanwhile.

    Results that are read lazily have to be written before the end:
    `with cleaned_up(spark): jobs.mine_log(...).write.parquet(...)`.
    """
    made: list[str] = []
    _OPEN.append(made)
    try:
        yield
    finally:
        _OPEN.remove(made)
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        for path in made:
            at = hadoop(path)
            at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def move_into_place(spark: SparkSession, source: str, target: str) -> None:
    """Rename a finished folder, in place of what an earlier attempt may have left under the name."""
    (old, files), (new, _) = _files(spark, source), _files(spark, target)
    files.delete(new, True)
    files.mkdirs(new.getParent())
    if not files.rename(old, new):
        raise OSError(f"could not rename {source} to {target}")


def _files(spark: SparkSession, path: str):
    """Hadoop's path and file system of a folder."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names below a folder, which need not exist."""
    at, files = _files(spark, path)
    return [status.getPath().getName() for status in files.listStatus(at)] if files.exists(at) else []


def remove(spark: SparkSession, path: str) -> None:
    at, files = _files(spark, path)
    files.delete(at, True)


def claim_place(spark: SparkSession, source: str, target: str) -> bool:
    """Rename a folder that holds files to a name that is not taken; whether it was this one.

    A rename onto a folder that exists moves the source into it or fails, whoever comes first; either is
    seen and undone.
    """
    old, files = _files(spark, source)
    new, _ = _files(spark, target)
    inside = _files(spark, f"{target}/{old.getName()}")[0]
    files.mkdirs(new.getParent())
    if not files.exists(new) and files.rename(old, new) and not files.exists(inside):
        return True
    files.delete(inside, True)
    files.delete(old, True)
    return False


def local_frame(spark: SparkSession, columns: dict[str, list]) -> DataFrame:
    """A caller's list as a DataFrame whose size the planner knows, so it may be broadcast."""
    return spark.createDataFrame(pa.table(columns))


def store(df: DataFrame, purpose: str) -> DataFrame:
    """The same rows as a table in the shared folder.

    For intermediate results that several steps read: they are computed once, survive a lost
    executor, and their size is known to the planner.
    """
    path = work_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
