"""Rows that stand for blocks of documents and meet in buckets of their keys."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext

BLOCKS = "bucket int, block long, info boolean, keys binary, owners binary, multiple binary"


def block_number(batch: int) -> int:
    return TaskContext.get().partitionId() << 32 | batch


def by_bucket(keys: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """Bucket and the places of its keys, in key order within a bucket if the keys are sorted."""
    bucket = (keys % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for b in range(buckets):
        if cuts[b] < cuts[b + 1]:
            yield b, order[cuts[b] : cuts[b + 1]]


def pack40(keys: np.ndarray) -> bytes:
    """The lowest 40 bits of each key."""
    return np.ascontiguousarray(keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()


def unpack40(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 5, 8), np.uint8)
    out[:, :5] = np.frombuffer(data, np.uint8).reshape(-1, 5)
    return out.view("<u8").ravel()


def records(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int64(), pa.bool_(), pa.binary(), pa.binary(), pa.binary())
    names = ["bucket", "block", "info", "keys", "owners", "multiple"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def to_ipc(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def read_ipc(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(data).read_all()
