"""Helpers the operators of this folder share."""

from __future__ import annotations

import ctypes
import re
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.session import fixed, scratch_path
from earshot.sources.shared import opened

# ASCII white space, as the contracts spell it.
SPACE = r"[\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


# Bytes of rows that a Python worker is handed at a time (a longer text alone).
BATCH_BYTES = 4 << 20


Task = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def give_back() -> None:
    """Return to the system what this process has freed; the C library and Arrow keep it for later otherwise."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidy(task: Task) -> Task:
    """A task after which its worker keeps nothing that it no longer uses.

    Spark keeps workers and lets them take turns, several for each core where functions
    follow each other in a task, so what idle ones keep counts beside the busy ones.
    """

    @wraps(task)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from task(batches)
        finally:
            give_back()

    return run


def texts(docs: DataFrame, *extra: Column) -> DataFrame:
    """``doc_id`` and whole ``text`` (null: empty), and nothing else that could clash.

    Texts go to Python in batches bounded by their bytes, not by their number alone.
    """
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
        *extra,
    )


def settled(docs: DataFrame) -> DataFrame:
    """The rows as a scan that gives them in the same order every time.

    A frame that is a file scan with projections and filters stays as it is;
    any other (shuffled, joined, made by a function) is written down first.
    """
    plan = docs._jdf.queryExecution().analyzed().toString().splitlines()
    nodes = {re.sub(r"[^A-Za-z].*", "", line.lstrip(" :+-'")) for line in plan}
    # Files give their rows in order; other sources (a database) need not.
    files = all(re.search(r"\] (parquet|orc|avro|json|csv|text)$", line) for line in plan if "Relation " in line.split("[")[0])
    return docs if files and nodes <= {"Project", "Filter", "Relation", "SubqueryAlias", "View", ""} else fixed(docs)


def numbered(docs: DataFrame, *extra: Column) -> DataFrame:
    """``texts`` of settled rows with ``_row``, which tells repeated rows apart: the place in the scan."""
    return texts(docs, *extra, F.monotonically_increasing_id().alias("_row"))


# Splits of a scan whose row lists share a folder, and text that one part of a shuffle of keys stands for.
LISTED_SPLITS, PART_BYTES = 8, 64 << 20


def key_parts(docs: DataFrame) -> int:
    """Parts for shuffles of what tasks hold in memory: as many as the texts' bytes ask for, the session's number at least."""
    size = texts(docs).agg(F.sum(F.octet_length("text"))).head()[0] or 0
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // PART_BYTES))


def row_lists(rows: DataFrame) -> str:
    """Store rows by number (``_row``, any other columns) and split of the scan they come from, for ``ListedRows`` to find.

    The high bits of a row number are its split, so tasks that scan the rows again
    read what is listed for their own split and no text is moved to join it.
    """
    path = scratch_path(rows.sparkSession, "row-lists")
    group = F.shiftright("_row", 33 + LISTED_SPLITS.bit_length() - 1)
    rows.withColumn("group", group).repartition("group").sortWithinPartitions("group", "_row").write.partitionBy("group").parquet(path)
    return path


class ListedRows:
    """What is listed for the split a task scans."""

    def __init__(self, path: str):
        self.path, self.split = path, -1
        self.rows, self.table = np.zeros(0, np.int64), None

    def _places(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place in the list of each row of a batch (of one split), and whether it is there."""
        split = int(rows[0]) >> 33
        if split != self.split:
            self.split = split
            self.table = self._read(split)
            self.rows = self.table["_row"].to_numpy() if self.table else np.zeros(0, np.int64)
        if not len(self.rows):
            return np.zeros(len(rows), np.int64), np.zeros(len(rows), bool)
        place = np.minimum(np.searchsorted(self.rows, rows), len(self.rows) - 1)
        return place, self.rows[place] == rows

    def among(self, rows: np.ndarray) -> np.ndarray:
        """Which rows are listed."""
        return self._places(rows)[1]

    def values(self, rows: np.ndarray, column: str) -> list:
        """The listed value of each row, nothing for rows that are not listed."""
        place, known = self._places(rows)
        if not known.any():
            return [None] * len(rows)
        return self.table[column].take(pa.array(place, mask=~known)).to_pylist()

    def _read(self, split: int) -> pa.Table | None:
        system, folder = opened(f"{self.path}/group={split // LISTED_SPLITS}")
        files = [f.path for f in system.get_file_info(fs.FileSelector(folder, allow_not_found=True)) if f.path.endswith(".parquet")]
        if not files:
            return None
        own = (pc.field("_row") >= split << 33) & (pc.field("_row") < (split + 1) << 33)
        found = [pq.read_table(f, filesystem=system, filters=own, partitioning=None) for f in files]
        return pa.concat_tables(found).sort_by("_row")


def listed_rows(docs: DataFrame, path: str, keep: bool = True) -> DataFrame:
    """The settled rows whose numbers are listed (or are not), with all their columns; nothing is moved."""
    # Plain names, as a function's columns are looked up by them.
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    rows = plain.withColumn("_row", F.monotonically_increasing_id())

    @tidy
    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed = ListedRows(path)
        for batch in batches:
            if batch.num_rows:
                found = listed.among(batch.column(batch.num_columns - 1).to_numpy())
                yield batch.filter(pa.array(found == keep))

    return rows.mapInArrow(pick, rows.schema).drop("_row").toDF(*docs.columns)


def with_listed(rows: DataFrame, path: str, column: str, kind: str) -> DataFrame:
    """The numbered rows that are listed, with a listed column of this type; nothing is moved."""
    columns = rows.columns

    @tidy
    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed = ListedRows(path)
        for batch in batches:
            if not batch.num_rows:
                continue
            numbers = batch.column("_row").to_numpy()
            known = listed.among(numbers)
            if known.any():
                values = pa.array([v for v, k in zip(listed.values(numbers, column), known.tolist()) if k])
                own = batch.filter(pa.array(known))
                yield pa.RecordBatch.from_arrays([*own.columns, values], [*columns, column])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(pick, f"{schema}, {column} {kind}")


def without(docs: DataFrame, *names: str) -> list[str]:
    """The input's columns but for those a result column of the same name takes the place of."""
    taken = {n.lower() for n in names}
    return [c for c in docs.columns if c.lower() not in taken]


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a text column without decoding them."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def slices(raw: list[bytes], most: int = 1 << 20) -> Iterator[tuple[int, list[bytes]]]:
    """Number of the first text and texts of up to ``most`` bytes together (a longer one alone)."""
    first, held = 0, 0
    for i, text in enumerate(raw):
        if i > first and held + len(text) > most:
            yield first, raw[first:i]
            first, held = i, 0
        held += len(text)
    if first < len(raw):
        yield first, raw[first:]


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash, in place."""
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


_MIX, _STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACES = np.zeros(256, bool)
_SPACES[[9, 10, 11, 12, 13, 32]] = True
_ALNUM = np.zeros(256, bool)
_ALNUM[48:58] = _ALNUM[97:123] = _ALNUM[128:] = True


class Words:
    """Words of some texts with 64-bit hashes: A-Z in lower case, whole words at any length."""

    def __init__(self, raw: list[bytes], letters_only: bool = False):
        self.starts = np.zeros(len(raw) + 1, np.int64)
        np.cumsum([len(t) + 1 for t in raw], out=self.starts[1:])
        self.raw = np.frombuffer(b"\n".join(raw) + b"\n" * 9, np.uint8)
        folded = _LOWER[self.raw]
        inside = _ALNUM[folded] if letters_only else ~_SPACES[folded]
        edges = np.diff(inside.astype(np.int8), prepend=np.int8(0))
        self.begin = np.flatnonzero(edges == 1)
        self.length = np.flatnonzero(edges == -1) - self.begin
        self.wide = folded.astype(np.uint64)
        self.wide[:-1] |= self.wide[1:] << np.uint64(8)
        self.wide[:-2] |= self.wide[2:] << np.uint64(16)
        self.wide[:-4] |= self.wide[4:] << np.uint64(32)
        self.text = np.searchsorted(self.starts, self.begin, "right") - 1

    def hashes(self, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Eight bytes at a time are folded into the hash."""
        out = length.astype(np.uint64) * _STEP
        todo = np.arange(len(begin))
        at, left = begin.astype(np.int64), length.astype(np.int64)
        while len(todo):
            lane = self.wide[at]
            short = left < 8
            lane[short] &= (np.uint64(1) << (np.uint64(8) * left[short].astype(np.uint64))) - np.uint64(1)
            out[todo] = mix((out[todo] ^ lane) * _MIX)
            more = left > 8
            todo, at, left = todo[more], at[more] + 8, left[more] - 8
        return out
