"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings every job relies on. AQE splits skewed join partitions
# even where that costs one more exchange, and naive timestamps are read as UTC.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Shuffles are cut finely and joined to parts of this size, so what a task holds does not grow with the input.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "600",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    # Rank filters cut each task's rows before the shuffle, for larger n as well.
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000000",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else made."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: int = 8, app: str = "earshot", memory: str = "8g") -> SparkSession:
    """Session for tests and the local bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors see, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of this machine.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return configured.rstrip("/")
    current = context.getCheckpointDir()
    if current is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        current = tempfile.mkdtemp(prefix="earshot-")
        context.setCheckpointDir(current)
        current = context.getCheckpointDir()
    return current.rstrip("/")


# Lists of the paths that open ``scratch_removed`` blocks have seen made.
_SEEN: list[list[str]] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other run uses."""
    path = os.path.join(shared_dir(spark), "earshot", f"{label}-{uuid.uuid4().hex}")
    for paths in _SEEN:
        paths.append(path)
    return path


@contextmanager
def scratch_removed(spark: SparkSession) -> Iterator[None]:
    """Delete what is written to scratch paths inside, once the block is through.

    For steps whose result is written elsewhere before the block ends; frames made inside
    cannot be read after it. A block that fails leaves its files.
    """
    paths: list[str] = []
    _SEEN.append(paths)
    try:
        yield
    finally:
        _SEEN[:] = [seen for seen in _SEEN if seen is not paths]
    for path in paths:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def fixed(df: DataFrame) -> DataFrame:
    """Rows that several results are made of: computed once, and kept if an executor is lost.

    They are written below the shared folder and read back, which cuts the
    lineage like a checkpoint and also tells the optimizer their size.
    """
    path = scratch_path(df.sparkSession, "rows")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
