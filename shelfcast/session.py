"""Session settings and durable stage storage shared by every operator."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context
from pathlib import Path
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession

T = TypeVar("T")
_shipped: set[str] = set()

# One local folder per Python process, used only when no shared folder is named and Spark runs in local mode.
_local_root: str | None = None
# Folder under the root that settled tables go to, if their maker wants them removed.
_run: ContextVar[str] = ContextVar("run", default="")
# Spark's option to remove the shuffle files of a query or write when it has ended, not when the driver next collects garbage.
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def ship(spark: SparkSession) -> None:
    """Give the package to the executors' Python workers, once per application, wherever the driver was started."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="shelfcast-ship-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)  # the driver serves the file while it lives
    archive = Path(folder) / "shelfcast.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as packed:
        for file in sorted(package.rglob("*.py")):
            packed.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def tune(spark: SparkSession) -> SparkSession:
    """Set the SQL options the plans rely on. Results do not depend on them, only the number of shuffles.

    A panel hashed on item_id already co-locates every (month, shop, item) key, so joins on the longer key must be
    allowed to reuse that layout instead of shuffling the dense side again.
    """
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    # The JVM never compiles a method of more bytes; such a stage of many columns runs by operators instead.
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ship(spark)
    return spark


def build_session(app: str = "shelfcast", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or reuse) a tuned session; keyword names use double underscores for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return tune(builder.getOrCreate())


def storage_root(spark: SparkSession) -> str:
    """Shared folder for cut lineage: the one the cluster names, else a private one in local mode only."""
    global _local_root
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="shelfcast-")
    return _local_root


@contextmanager
def dropped_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what runs inside go as soon as their query or write has ended."""
    kept = spark.conf.get(_DROP_SHUFFLES, None)
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if kept is None:
            spark.conf.unset(_DROP_SHUFFLES)
        else:
            spark.conf.set(_DROP_SHUFFLES, kept)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Tables settled inside are removed at the end, so results built on them must be consumed or written inside.

    Shuffle files of what runs inside go as soon as their query has ended, so disk holds those of one step at a time.
    The function it gives settles a result where it outlasts this scratch, and ends with the one around it, if any.
    """
    around = _run.get()
    token = _run.set(f"run-{uuid.uuid4().hex}/")
    folder = f"{storage_root(spark)}/{_run.get()}"
    try:
        with dropped_shuffles(spark):
            yield lambda df: _written(df, around)
    finally:
        _run.reset(token)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Cuts lineage, survives lost executors, keeps column pruning, and gives the planner true sizes. The table stays
    until its ``scratch`` ends, or for good outside one: a lazy result may be read at any time.
    """
    return _written(df, _run.get())


def _written(df: DataFrame, folder: str) -> DataFrame:
    spark = df.sparkSession
    path = f"{storage_root(spark)}/{folder}settled-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def in_parallel(*steps: Callable[[], T]) -> list[T]:
    """Run independent steps that start Spark jobs at the same time; the scheduler shares the executors among them."""
    with ThreadPoolExecutor(len(steps)) as pool:
        return [f.result() for f in [pool.submit(copy_context().run, step) for step in steps]]


def settle_all(*tables: DataFrame) -> list[DataFrame]:
    """Settle independent tables side by side."""
    return in_parallel(*[lambda t=t: settle(t) for t in tables])


def parallelism(spark: SparkSession) -> int:
    """Number of partitions for an explicit repartition of something that will grow afterwards."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
