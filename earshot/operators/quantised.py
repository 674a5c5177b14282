"""Approximate search over inverted lists of product-quantised vectors.

The index holds, per cell, the ids of its vectors and a code of a few bytes for each: the
nearest entry of a codebook for every part of what is left of the vector without
its cell's centre. A vector stands in several cells, so that a query finds it in
few of them. A search adds up table entries over the lists of its nearest cells and scores
its best candidates again by their vectors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.functions.grouping import top_n
from earshot.operators.scoring import RESULT_SCHEMA, matrix, rescored, unit
from earshot.session import scratch_path
from earshot.sources.shared import held, opened

# Rows the centres and codebooks are fitted on at most, and rounds of fitting.
SAMPLE_ROWS, ROUNDS = 20_000, 12
# Cells a vector stands in, parts of a code, entries of a codebook: a byte a part.
SPILL, PARTS, ENTRIES = 3, 16, 256
# Share of the cells a search opens, and candidates a query scores exactly.
PROBED, SHORTLIST = 0.25, 100
# Rows of a list in one file, on average; a long list is several files.
FILE_ROWS = 500_000
# Queries and list rows that are scored together, and rows that meet all cells at a time.
QUERY_TILE, LIST_TILE, ROW_TILE = 512, 4096, 256
# Candidates a task gathers before it keeps the best, and how many of these it still holds back.
MAX_FOUND, MAX_KEPT = 1_000_000, 750_000


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Short batches, as what is worked out per row is as wide as there are cells."""
    for batch in batches:
        for first in range(0, batch.num_rows, ROW_TILE):
            yield batch.slice(first, ROW_TILE)


class Quantiser(NamedTuple):
    """Unit centres of the cells, and a codebook for every part."""

    centres: np.ndarray
    books: list[np.ndarray]

    def parts(self, vectors: np.ndarray) -> list[np.ndarray]:
        edges = np.cumsum([0, *[book.shape[1] for book in self.books]])
        return [vectors[:, a:b] for a, b in zip(edges, edges[1:])]

    def nearest(self, vectors: np.ndarray, n: int) -> np.ndarray:
        return np.argsort(-(vectors @ self.centres.T), axis=1, kind="stable")[:, :n]

    def encode(self, rest: np.ndarray) -> np.ndarray:
        codes = [_closest(part, book) for part, book in zip(self.parts(rest), self.books)]
        return np.stack(codes, axis=1).astype(np.uint8)

    def tables(self, queries: np.ndarray) -> list[np.ndarray]:
        """Product of every query's part with every entry of the part's codebook."""
        return [part @ book.T for part, book in zip(self.parts(queries), self.books)]


def _closest(rows: np.ndarray, entries: np.ndarray) -> np.ndarray:
    return np.argmax(2 * rows @ entries.T - (entries * entries).sum(axis=1), axis=1)


def _fit(rows: np.ndarray, count: int, seed: int) -> np.ndarray:
    """Means of ``count`` groups of rows (fewer where there are fewer rows)."""
    dice = np.random.default_rng(seed)
    means = rows[np.sort(dice.choice(len(rows), min(count, len(rows)), replace=False))]
    for _ in range(ROUNDS):
        own = _closest(rows, means)
        size = np.bincount(own, minlength=len(means))
        sums = np.zeros_like(means)
        np.add.at(sums, own, rows)
        means = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], means)
    return means


def _usable(embeddings: DataFrame) -> DataFrame:
    """Rows whose vector has a direction."""
    vector = F.col("transcript_embedding")
    return embeddings.select(
        F.col("episode_id").cast("bigint").alias("episode_id"),
        F.col("chunk_index").cast("bigint").alias("chunk_index"),
        "transcript_embedding",
    ).filter(F.forall(vector, lambda x: x.isNotNull()) & F.exists(vector, lambda x: x != 0))


def train(embeddings: DataFrame, cells: int | None = None, parts: int = PARTS, seed: int = 7) -> Quantiser:
    """Centres and codebooks, fitted on at most ``SAMPLE_ROWS`` rows by hash order.

    Unless told, there are as many cells as the square root of the number of rows, 64 at least.
    """
    usable = _usable(embeddings)
    if cells is None:
        cells = max(64, math.isqrt(usable.count()))
    picked = usable.orderBy(F.xxhash64("episode_id", "chunk_index"), "episode_id", "chunk_index").limit(SAMPLE_ROWS)
    sample = unit(matrix(picked.select("transcript_embedding").toArrow()["transcript_embedding"]))
    if not len(sample):
        return Quantiser(np.zeros((0, 0)), [])
    centres = unit(_fit(sample, cells, seed))
    rest = sample - centres[np.argmax(sample @ centres.T, axis=1)]
    pieces = np.array_split(rest, min(parts, rest.shape[1]), axis=1)
    return Quantiser(centres, [_fit(piece, ENTRIES, seed + 1 + i) for i, piece in enumerate(pieces)])


def build_index(embeddings: DataFrame, path: str, quantiser: Quantiser, spill: int = SPILL) -> None:
    """Write every row with a direction to the lists of its ``spill`` nearest cells, a folder a cell.

    Rows of a cell are cut into several files, so a large cell is written and read by many tasks.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _tiles(batches):
            vectors = unit(matrix(batch.column("transcript_embedding")))
            cells = quantiser.nearest(vectors, spill)
            take = np.repeat(np.arange(len(vectors)), cells.shape[1])
            codes = quantiser.encode(vectors[take] - quantiser.centres[cells.ravel()])
            columns = [batch.column(c).take(pa.array(take)) for c in ("episode_id", "chunk_index")]
            packed = pa.array([c.tobytes() for c in codes], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(cells.ravel().astype(np.int64)), packed], ["episode_id", "chunk_index", "cell", "code"]
            )

    usable = _usable(embeddings)
    slices = max(1, math.ceil(usable.count() * spill / max(1, len(quantiser.centres)) / FILE_ROWS))
    lists = usable.mapInArrow(encode, "episode_id bigint, chunk_index bigint, cell bigint, code binary")
    lists.repartition("cell", F.pmod(F.xxhash64("episode_id", "chunk_index"), F.lit(slices))).write.partitionBy("cell").parquet(path)


def _probes(queries: DataFrame, quantiser: Quantiser, n: int) -> DataFrame:
    """Every query with each of its ``n`` nearest cells; a query without direction asks none."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _tiles(batches):
            cells = quantiser.nearest(unit(matrix(batch.column("query_vector"))), n)
            take = pa.array(np.repeat(np.arange(batch.num_rows), cells.shape[1]))
            columns = [batch.column(c).take(take) for c in ("query_id", "query_vector")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(cells.ravel().astype(np.int64))], ["query_id", "query_vector", "cell"]
            )

    vector = F.col("query_vector")
    asked = queries.select(F.col("query_id").cast("bigint").alias("query_id"), vector.cast("array<double>").alias("query_vector"))
    asked = asked.filter(F.forall(vector, lambda x: x.isNotNull()) & F.exists(vector, lambda x: x != 0))
    return asked.mapInArrow(assign, "query_id bigint, query_vector array<double>, cell bigint")


def _best(found: list[tuple[np.ndarray, ...]], keep: int) -> tuple[np.ndarray, ...]:
    """The ``keep`` best candidates of each query, each once."""
    query, episode, chunk, score = (np.concatenate(c) for c in zip(*found))
    order = np.lexsort((-score, chunk, episode, query))
    query, episode, chunk, score = (c[order] for c in (query, episode, chunk, score))
    new = np.ones(len(query), bool)
    new[1:] = (np.diff(query) != 0) | (np.diff(episode) != 0) | (np.diff(chunk) != 0)
    query, episode, chunk, score = (c[new] for c in (query, episode, chunk, score))
    order = np.lexsort((chunk, episode, -score, query))
    query = query[order]
    starts = np.flatnonzero(np.r_[True, np.diff(query) != 0]) if len(query) else np.zeros(0, int)
    place = np.arange(len(query)) - np.repeat(starts, np.diff(np.append(starts, len(query))))
    order = order[place < keep]
    return query[place < keep], episode[order], chunk[order], score[order]


def _scan_lists(lists: DataFrame, probes: str, quantiser: Quantiser, keep: int) -> DataFrame:
    """Candidates of every query out of the lists, by table look-ups; tasks read the queries of their cells."""

    def queries_of(cell: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        system, folder = opened(f"{probes}/cell={cell}")
        for file in system.get_file_info(pa.fs.FileSelector(folder, allow_not_found=True)):
            if file.path.endswith(".parquet"):
                for batch in pq.ParquetFile(system.open_input_file(file.path)).iter_batches(QUERY_TILE):
                    yield batch.column("query_id").to_numpy(), unit(matrix(batch.column("query_vector")))

    def batch_of(best: tuple[np.ndarray, ...]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c) for c in best], ["query_id", "episode_id", "chunk_index", "score"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in held(batches):
            table = pa.Table.from_batches(part)
            cells = table["cell"].to_numpy()
            found, size = [], 0
            for cell in np.unique(cells):
                rows = table.take(pa.array(np.flatnonzero(cells == cell)))
                codes = np.frombuffer(b"".join(rows["code"].to_pylist()), np.uint8).reshape(len(rows), -1)
                episodes, chunks = rows["episode_id"].to_numpy(), rows["chunk_index"].to_numpy()
                for ids, vectors in queries_of(int(cell)):
                    tables, base = quantiser.tables(vectors), vectors @ quantiser.centres[cell]
                    for first in range(0, len(rows), LIST_TILE):
                        part_codes = codes[first : first + LIST_TILE]
                        scores = np.repeat(base[:, None], len(part_codes), axis=1)
                        for m, entries in enumerate(tables):
                            scores += entries[:, part_codes[:, m]]
                        n = min(keep, scores.shape[1])
                        best = np.argpartition(-scores, n - 1, axis=1)[:, :n]
                        own = first + best.ravel()
                        found.append((np.repeat(ids, n), episodes[own], chunks[own], np.take_along_axis(scores, best, 1).ravel()))
                        size += len(own)
                        if size > MAX_FOUND:
                            found = [_best(found, keep)]
                            size = len(found[0][0])
                        # Those of very many queries go on as they are; they are merged after the tasks in any case.
                        if size > MAX_KEPT and len(found) == 1:
                            yield batch_of(found[0])
                            found, size = [], 0
            if found:
                yield batch_of(_best(found, keep))

    return lists.mapInArrow(scan, RESULT_SCHEMA)


def quantised_search(
    queries: DataFrame, embeddings: DataFrame, path: str, quantiser: Quantiser, k: int = 5,
    probed: float = PROBED, shortlist: int = SHORTLIST,
) -> DataFrame:
    """Best chunks per query (``query_id, query_vector``) among the lists of its nearest cells: ``similarity``, ``rank``.

    ``probed`` is the share of the cells a query opens. Scores and their order are those of the vectors themselves;
    only which ``shortlist`` chunks are looked at is approximate.
    """
    spark: SparkSession = queries.sparkSession
    if not len(quantiser.centres):
        empty = spark.createDataFrame([], RESULT_SCHEMA.replace("score", "similarity"))
        return empty.withColumn("rank", F.lit(1))
    probes = _probes(queries, quantiser, max(1, int(len(quantiser.centres) * probed)))
    asked = scratch_path(spark, "probes")
    probes.repartition("cell").write.partitionBy("cell").parquet(asked)
    lists = spark.read.schema("episode_id bigint, chunk_index bigint, code binary, cell bigint").parquet(path)
    found = _scan_lists(lists, asked, quantiser, shortlist)
    once = found.groupBy("query_id", "episode_id", "chunk_index").agg(F.max("score").alias("about"))
    near = top_n(once, ["query_id"], [F.col("about").desc(), F.col("episode_id"), F.col("chunk_index")], shortlist,
                 salt_by=["episode_id", "chunk_index"])
    pairs = near.select("query_id", "episode_id", "chunk_index").join(
        _usable(embeddings).withColumnRenamed("transcript_embedding", "vector"), ["episode_id", "chunk_index"]
    )
    vectors = queries.select(F.col("query_id").cast("bigint").alias("query_id"), "query_vector")
    scored = rescored(pairs.join(vectors, "query_id"))
    best = top_n(scored, ["query_id"], [F.col("score").desc(), F.col("episode_id"), F.col("chunk_index")], k,
                 salt_by=["episode_id", "chunk_index"])
    return best.withColumnRenamed("score", "similarity")
