"""Session helpers: a local session for tests/bench, and lineage cutting that survives executor loss."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tidings") -> SparkSession:
    """A local session for tests and the benchmark. Cluster jobs get their session from the platform."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.files.openCostInBytes", "65536")
        .config("spark.sql.files.maxPartitionBytes", os.environ.get("TIDINGS_SPLIT_BYTES", str(8 << 20)))
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("TIDINGS_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir`` (None when unset)."""
    d = spark.sparkContext.getCheckpointDir()
    if d:
        return d
    conf = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    return conf or None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder. Only a local session (tests, bench) without one gets a scratch
    folder; a cluster session must name a shared folder in ``spark.checkpoint.dir``, because a
    machine-local folder would not survive the loss of the machine."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    d = checkpoint_dir(spark)
    if d is None:
        if not (sc.master or "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (stage tables and round states go there)")
        d = tempfile.mkdtemp(prefix="tidings-ckpt-", dir=os.environ.get("TIDINGS_SCRATCH", "/tmp"))
    sc.setCheckpointDir(d)  # Spark adds one application subfolder under it
    return sc.getCheckpointDir() or d


def cut_lineage(df: DataFrame, scoped: bool = True) -> DataFrame:
    """Cut the lineage with a table written to the shared checkpoint folder and read back.

    Parquet in ``spark.checkpoint.dir`` survives executor loss like a reliable checkpoint, is columnar and
    compressed (cheaper than serialised RDD blocks) and gives the optimizer real sizes. Never a local
    checkpoint, never a machine-local folder on a cluster. The table lives until :func:`release`, until the
    enclosing :func:`stage_scope` ends (unless not ``scoped``), or until :func:`release_all` at the end of the job.
    """
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/tables/{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stage_path = path
    (_SCOPES.stack[-1] if _SCOPES.stack and scoped else _OPEN).append(path)
    return out


class _Scopes(threading.local):
    """The open scopes of a thread, so that jobs of several threads do not delete each other's tables."""

    def __init__(self):
        self.stack: list[list[str]] = []


_OPEN: list[str] = []  # stage tables outside any scope
_SCOPES = _Scopes()


def _delete(spark: SparkSession, path: str) -> None:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


def release(df: DataFrame) -> None:
    """Delete the table behind a :func:`cut_lineage` result once nothing reads it any more."""
    path = getattr(df, "_stage_path", None)
    if path is None:
        raise ValueError("not a stage table")
    for held in [_OPEN, *_SCOPES.stack]:
        if path in held:
            held.remove(path)
    _delete(df.sparkSession, path)


@contextmanager
def stage_scope(spark: SparkSession):
    """Stage tables written inside are deleted at the end, but for those passed to the yielded ``keep``."""
    _SCOPES.stack.append([])
    kept: list[str] = []

    def keep(df: DataFrame) -> DataFrame:
        kept.append(df._stage_path)
        return df

    try:
        yield keep
    finally:
        written = _SCOPES.stack.pop()
        outer = _SCOPES.stack[-1] if _SCOPES.stack else _OPEN
        for path in written:
            if path in kept:
                outer.append(path)
            else:
                _delete(spark, path)


def release_all(spark: SparkSession) -> None:
    """Delete every stage table of the session that is left (end of a job; results must have been written)."""
    while _OPEN:
        _delete(spark, _OPEN.pop())


def checkpoint_round(df: DataFrame) -> DataFrame:
    """State of a round (greedy dedup, components, spanning trees) as a written table, see :func:`cut_lineage`.

    Not ``DataFrame.checkpoint()``: its result keeps the optimizer's size estimate of the plan that made it, a
    product over all joins, so the digits of the estimate multiply from round to round and planning takes
    longer than the work after a few of them. A table read back has its real size. The states are small and results
    refer to them, so they outlive the enclosing scope.
    """
    return cut_lineage(df, scoped=False)
