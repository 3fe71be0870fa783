"""Session construction and lineage-cutting helpers."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the library relies on. AQE re-plans joins from runtime sizes
# (broadcast only when a shuffle stage turns out small, skew-join splitting for
# hot keys), UTC keeps date truncation stable, the UI stays off.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "shiftwise", extra: dict | None = None,
                driver_memory: str | None = "8g") -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if driver_memory:
        # local mode runs every task inside the driver JVM
        conf["spark.driver.memory"] = driver_memory
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def is_local(spark: SparkSession) -> bool:
    """True where driver and tasks share one machine (``local`` masters, not ``local-cluster``)."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster must name a shared (distributed) folder there; without one this
    raises, because a machine-local folder would lose rows. Only a ``local``
    master, as in tests, falls back to ``fallback`` or a new temporary folder.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not is_local(spark):
            raise RuntimeError("spark.checkpoint.dir is not set; name a folder that all executors share")
        d = fallback or tempfile.mkdtemp(prefix="shiftwise-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def run_folder(spark: SparkSession, run_id: str | None = None) -> str:
    """A folder for one run's written tables under the checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/tables/{run_id or uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a run folder through Spark's file system (any store Spark can write to)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


#: Deletes the shuffle files of a query when it ends; otherwise they stay until the driver happens to collect garbage.
CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_scratch: list[list[str]] = []  # the run folders of the scratch blocks that are open


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes on leaving what :func:`materialize` wrote inside, but for tables that are ``kept`` or have a run id."""
    _scratch.append([])
    try:
        yield
    finally:
        for folder in _scratch.pop():
            remove_folder(spark, folder)


def materialize(df: DataFrame, name: str, run_id: str | None = None, kept: bool = False) -> DataFrame:
    """Write ``df`` as Parquet under the checkpoint folder and read it back.

    Cuts lineage so a lost executor re-reads files instead of recomputing the
    whole upstream plan, and gives the planner real file sizes for its join
    choices. The query's shuffle files go when it has written. A ``kept`` table
    outlives the innermost :func:`scratch` block.
    """
    spark = df.sparkSession
    folder = run_folder(spark, run_id)
    if run_id is None and len(_scratch) > kept:
        _scratch[-2 if kept else -1].append(folder)
    path = f"{folder}/{name}"
    before = spark.conf.get(CLEAN_SHUFFLES, None)
    spark.conf.set(CLEAN_SHUFFLES, "true")
    try:
        df.write.mode("overwrite").parquet(path)
    finally:
        spark.conf.unset(CLEAN_SHUFFLES) if before is None else spark.conf.set(CLEAN_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)
