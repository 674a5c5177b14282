"""Files below the shared folder that tasks read by themselves, so that the driver handles names only."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame

from earshot.session import scratch_path
from earshot.sources.tables import file_system

HELD_BYTES = 16 << 20


def write_blocks(df: DataFrame, blocks: int, by: str, label: str) -> list[str]:
    """Write a frame as at most so many Parquet files, dealt by a column, and give their addresses."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.repartition(blocks, by).write.parquet(path)
    system, folder = file_system(spark, path)
    names = [status.getPath().toString() for status in system.listStatus(folder)]
    return sorted(name for name in names if name.endswith(".parquet"))


def opened(address: str) -> tuple[fs.FileSystem, str]:
    """File system and path of an address below the shared folder. It needs a scheme that pyarrow knows."""
    if address.startswith("file:/") and not address.startswith("file://"):
        address = "file://" + address.removeprefix("file:")
    return fs.FileSystem.from_uri(address)


def read_block(address: str) -> pa.Table:
    """One of these files, in a task."""
    system, path = opened(address)
    with system.open_input_file(path) as file:
        return pq.read_table(file)


def held(batches: Iterator[pa.RecordBatch], most: int = HELD_BYTES) -> Iterator[list[pa.RecordBatch]]:
    """Batches of up to ``most`` bytes together, which a task holds while files pass by."""
    kept, size = [], 0
    for batch in batches:
        if kept and size + batch.nbytes > most:
            yield kept
            kept, size = [], 0
        kept.append(batch)
        size += batch.nbytes
    if kept:
        yield kept
