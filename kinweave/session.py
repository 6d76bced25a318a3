"""Session set-up and lineage cuts."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession


def local_session(cpus: int | str = "*", memory: str = "8g", app: str = "kinweave") -> SparkSession:
    """Session for one machine. On a cluster the submitter's settings are used as they are."""
    n = os.cpu_count() if cpus == "*" else int(cpus)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(n))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, whatever folder the driver started in.

    A zip of the package's sources goes to the executors as a file of the job, once per application.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    home = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="kinweave-ship-")
    atexit.register(shutil.rmtree, folder, True)
    target = f"{folder}/kinweave_package.zip"
    with zipfile.ZipFile(target, "w") as z:
        for source in sorted(home.rglob("*.py")):
            z.write(source, f"{home.name}/{source.relative_to(home)}")
    spark.sparkContext.addPyFile(target)
    _shipped.add(app)


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for written intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session without that setting gets
    a folder of its own; on a cluster a machine-local folder would be lost with its machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    own = tempfile.mkdtemp(prefix="kinweave-ckpt-")
    atexit.register(shutil.rmtree, own, True)
    spark.sparkContext.setCheckpointDir(own)
    return own


_scopes: ContextVar[tuple[list[Callable[[], None]], ...]] = ContextVar("scratch scopes", default=())


def _forget(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def _new_path(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_root(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"


def scratch_path(spark: SparkSession, name: str, outlives: bool = False) -> str:
    """A new folder for a written intermediate table.

    Inside a ``discarded`` block it goes with the block, or, with ``outlives``, with the block around that one.
    """
    path = _new_path(spark, name)
    scopes = _scopes.get()[:-1] if outlives else _scopes.get()
    if scopes:
        scopes[-1].append(lambda: _forget(spark, path))
    return path


@contextmanager
def discarded(spark: SparkSession) -> Iterator[None]:
    """Delete the intermediate tables written inside the block when it ends.

    Whatever leaves the block must read none of them; its own input is cut with ``outlives``.
    """
    own: list[Callable[[], None]] = []
    token = _scopes.set((*_scopes.get(), own))
    try:
        yield
    finally:
        _scopes.reset(token)
        for forget in own:
            forget()


def write_and_read(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` once and return the scan of the written files.

    The new plan starts at a table whose size the optimizer knows, and losing an executor costs
    nothing that was already written.
    """
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def exchanged(df: DataFrame) -> DataFrame:
    """``df``, a table that grows with the input, joined by exchange however small it looks.

    Spark broadcasts by the size of compressed files, a small part of what text ids take in the driver, and a loop does so every
    round. With the hint no such table passes through the driver. ``broadcast`` on the other side goes before it.
    """
    return df.hint("merge")


def cut(df: DataFrame, name: str = "cut", partition_by: tuple[str, ...] = (), outlives: bool = False) -> DataFrame:
    """Cut the lineage of ``df`` at a table in the checkpoint folder; ``outlives`` as for ``scratch_path``."""
    return write_and_read(df, scratch_path(df.sparkSession, name, outlives), partition_by)


def bucketed(
    df: DataFrame, name: str, keys: list[str], buckets: int, partition_by: tuple[str, ...] = (), placed: bool = False,
    owner: list[Callable[[], None]] | None = None,
) -> DataFrame:
    """Write ``df`` hashed and sorted by ``keys`` into ``buckets`` files and return the scan of the table.

    ``placed`` says that its partitions are such buckets already. With an ``owner`` the table stays until what is added to that
    list is called, whatever block is around.

    Two such tables of equal keys and bucket numbers are joined on the keys, or grouped by them, without an exchange.
    The files lie in the checkpoint folder; the table's entry in the catalog goes with the ``discarded`` block around it.
    """
    spark = df.sparkSession
    path, table = _new_path(spark, name), f"{name.replace('-', '_')}_{uuid.uuid4().hex[:12]}"
    scopes = _scopes.get()
    if owner is None and scopes:
        owner = scopes[-1]
    if owner is not None:
        owner += [lambda: spark.sql(f"DROP TABLE IF EXISTS {table}"), lambda: _forget(spark, path)]
    writer = (df if placed else df.repartition(buckets, *keys)).write.format("parquet").option("path", path)
    writer = writer.bucketBy(buckets, *keys).sortBy(*keys)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(table)
    return spark.table(table).select(*df.columns)


def observed(seen: Observation, written: DataFrame, *counts: str) -> list[int]:
    """Counts that the job writing ``written`` took on the way.

    An input found empty at run time is removed from the plan together with its observation, and then
    there is nothing to get.
    """
    try:
        return [seen.get[c] for c in counts]
    except Py4JJavaError:
        if written.isEmpty():
            return [0] * len(counts)
        raise


class LoopState:
    """State of an iterative job, written every round into one of two alternating folders.

    Round ``r`` reads the folder that round ``r + 1`` does not write, so the loop never holds more
    than two generations on disk whatever the number of rounds.
    """

    def __init__(self, spark: SparkSession, name: str):
        self._path = scratch_path(spark, name)
        self._turn = 0

    def advance(self, df: DataFrame, name: str = "") -> DataFrame:
        """``name`` tells a second table of the loop apart; the folder it had a round ago is written anew."""
        self._turn += not name
        return exchanged(write_and_read(df, f"{self._path}/{name}{'ab'[self._turn % 2]}"))
