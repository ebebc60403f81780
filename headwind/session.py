"""Session defaults and the shared folder for checkpoints and written intermediates."""

from __future__ import annotations

import itertools
import os
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "headwind", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library is tuned for. `conf` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # split a skewed join side even where that costs one more exchange
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        # raw snapshot files are large values: bound an Arrow batch by bytes, not only by rows
        "spark.sql.execution.arrow.maxBytesPerBatch": str(64 << 20),
    }
    for key, value in defaults.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach: `spark.checkpoint.dir`, set here only if it is unset."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    root = tempfile.mkdtemp(prefix="headwind-")
    spark.conf.set("spark.checkpoint.dir", root)
    spark.sparkContext.setCheckpointDir(root)
    return root


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A path nobody used before, below the shared root."""
    return os.path.join(shared_root(spark), "headwind", f"{purpose}-{uuid.uuid4().hex}")


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """A stage function whose tables are removed at the end of the block."""
    folder = new_folder(spark, "scratch")
    count = itertools.count()

    def stage(df: DataFrame) -> DataFrame:
        path = f"{folder}/{next(count)}"
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    try:
        yield stage
    finally:
        remove(spark, [folder])


def remove(spark: SparkSession, folders: Iterable[str]) -> None:
    """Delete folders with all that is in them."""
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


_kept: ContextVar[list[str] | None] = ContextVar("kept", default=None)


@contextmanager
def noting() -> Iterator[list[str]]:
    """The folders that `materialize` writes in the block, for a caller that knows when they are read."""
    found: list[str] = []
    before = _kept.set(found)
    try:
        yield found
    finally:
        _kept.reset(before)


def materialize(df: DataFrame, purpose: str = "stage", **options: object) -> DataFrame:
    """Write once and read back. Ends the lineage and survives the loss of executors.

    For results that outlive the call; jobs use `scratch`, callers that know the last reader `noting`
    or `settled`. `options` are the writer's, with `__` for dots.
    """
    spark = df.sparkSession
    path = new_folder(spark, purpose)
    noted = _kept.get()
    if noted is not None:
        noted.append(path)
    df.write.options(**{k.replace("__", "."): v for k, v in options.items()}).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def settled(spark: SparkSession, make: Callable[[], DataFrame], purpose: str = "stage") -> DataFrame:
    """What `make` returns, written; all that it wrote on the way is deleted.

    Only for a `make` that hands nothing else to later readers.
    """
    with noting() as made:
        found = materialize(make(), purpose)
    *used, last = made
    remove(spark, used)
    outer = _kept.get()
    if outer is not None:
        outer.append(last)
    return found


_LET_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def letting_go(spark: SparkSession) -> Iterator[None]:
    """Within the block, the shuffle files of a query are deleted when it ends.

    For loops of written stages, whose shuffles nobody reads again.
    """
    before = spark.conf.get(_LET_GO)
    spark.conf.set(_LET_GO, "true")
    try:
        yield
    finally:
        spark.conf.set(_LET_GO, before)
