"""Session helpers: a tuned local session, and reliable lineage cuts."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "barloom") -> SparkSession:
    """Session for tests and the benchmark; on a cluster use the session you are given."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        # Methods the JIT would refuse are split into smaller ones instead.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """``values`` hold for what is run inside; the session's own settings come back after it."""
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def short_methods(spark: SparkSession):
    """Wide expressions run as methods that the JIT takes: it leaves those of over 8,000 bytes to the interpreter."""
    limit = int(spark.conf.get("spark.sql.codegen.hugeMethodLimit", "65535"))
    return settings(spark, {"spark.sql.codegen.hugeMethodLimit": str(min(limit, 8000))})


def settle(df: DataFrame, batch_rows: int | None = None) -> DataFrame:
    """Cut the lineage of ``df`` with a reliable checkpoint.

    The folder is the one the cluster names in ``spark.checkpoint.dir``. Only a local
    session without that setting gets a folder of its own; anywhere else a machine-local
    folder would be lost with the machine, so that is an error. Shuffle files behind the rows go at once, not
    when the driver happens to collect its garbage. ``batch_rows``: at most so many rows go to a Python worker
    at once; executor and worker both hold a batch, several times over.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="barloom-checkpoint-")
        sc.setCheckpointDir(folder)
    values = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
    if batch_rows:
        held = int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000"))
        values["spark.sql.execution.arrow.maxRecordsPerBatch"] = str(min(held, batch_rows) if held > 0 else batch_rows)
    # A query takes the setting when it is made, so it is made anew here.
    with short_methods(spark), settings(spark, values):
        return df.select("*").checkpoint(eager=True)


def scratch(spark: SparkSession) -> str:
    """A new folder's path below the folder that driver and executors share (``spark.checkpoint.dir``)."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="barloom-shared-")
    return f"{folder}/{uuid.uuid4().hex}"


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers, wherever they run. Once per application."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    home = os.path.dirname(os.path.abspath(__file__))
    base = os.path.join(tempfile.mkdtemp(prefix="barloom-ship-"), "barloom")
    archive = shutil.make_archive(base, "zip", os.path.dirname(home), "barloom")
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(app)
