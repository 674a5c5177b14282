"""Exact top-k scoring of a table of query vectors against a chunk corpus.

The corpus is scanned in Arrow batches; a batch is scored against a block of
queries as one matrix product and only the best ``k`` rows per query leave the
task. Queries stand in files of up to ``max_query_bytes`` below the shared folder, which
the tasks that scan the corpus read themselves, so neither side is moved nor passes
the driver. No pair of query and chunk is ever written out as a row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.functions.grouping import top_n
from earshot.session import fixed
from earshot.sources.shared import held, read_block, write_blocks

# The matrix product only preselects: it may be off by so much (for distances
# relative to the vectors' squared lengths), and what passes is scored again row
# by row, so that equal vectors have equal scores wherever they are scored.
MARGIN = 1e-9
# Scores a task computes at a time, and rows it gathers before it keeps the best.
MAX_SCORES, MAX_PENDING = 250_000, 250_000
CORPUS_TILE = 2048
# Rows of the first tile where what a query has found bounds the next ones; each next tile is twice as large.
FIRST_TILE = 128
# Pairs that are scored row by row at a time.
PAIRS_TOGETHER = 16_384
# Bytes of queries in one file; four tasks of an executor hold one each.
MAX_QUERY_BYTES = 16 << 20
# Hit tables of at most this many rows are small enough to send to every task.
SMALL_HITS = 100_000
RESULT_SCHEMA = "query_id bigint, episode_id bigint, chunk_index bigint, score double"
_ARROW_SCHEMA = pa.schema(
    [("query_id", pa.int64()), ("episode_id", pa.int64()), ("chunk_index", pa.int64()), ("score", pa.float64())]
)


@dataclass(frozen=True)
class Ranking:
    """What to keep per query: the best ``k`` chunks, or episodes by their best chunk."""

    k: int
    metric: str = "cosine"
    threshold: float | None = None
    per_episode: bool = False
    skip_own_episode: bool = False

    def __post_init__(self):
        if self.k <= 0:
            raise ValueError("k must be positive")
        if self.metric not in ("cosine", "l2"):
            raise ValueError("metric must be cosine or l2")

    @property
    def best_first(self) -> int:
        """Sign that turns the score into a sort key with the best row lowest."""
        return -1 if self.metric == "cosine" else 1


class Hits(NamedTuple):
    """Ranked hits (``query_id, episode_id, chunk_index, score, rank``; no chunk for episode rankings)
    and whether queries times ``k`` proves them small."""

    frame: DataFrame
    small: bool

    def hinted(self, df: DataFrame | None = None) -> DataFrame:
        """The hits, or a frame with one row per hit, ready for a join with a large table."""
        df = self.frame if df is None else df
        return F.broadcast(df) if self.small else df


@dataclass
class _Queries:
    ids: np.ndarray
    vectors: np.ndarray
    own_episode: np.ndarray
    match: np.ndarray | None

    @cached_property
    def directions(self) -> np.ndarray:
        return _directions(self.vectors)

    @cached_property
    def directed(self) -> np.ndarray:
        """Which of them have a direction and so can match anything."""
        return ~np.isnan(unit(self.vectors)).any(axis=1)

    @classmethod
    def read(cls, table: pa.Table) -> "_Queries":
        names = table.column_names
        return cls(
            table["query_id"].to_numpy(),
            matrix(table["query_vector"]),
            table["own_episode"].to_numpy(zero_copy_only=False),
            table["match"].to_numpy() if "match" in names else None,
        )


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if len(array) == 0:
        return np.zeros((0, 0))
    flat = array.flatten()
    sizes = pc.unique(pc.list_value_length(array))
    if array.null_count or flat.null_count or len(sizes) != 1:
        raise ValueError("vectors must be present, without nulls and of one dimension")
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(array), -1)


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; rows without direction become NaN and match nothing."""
    length = np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
    return np.divide(vectors, length, out=np.full_like(vectors, np.nan), where=length > 0)


def _directions(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors in single precision, zeros for rows without direction."""
    return np.nan_to_num(unit(vectors)).astype(np.float32)


def _direction_margin(dim: int) -> float:
    """How far off a product of such directions may be, twice over: every step rounds by 2^-24 at most of parts that sum to one."""
    return (dim + 8) * 2.0**-23


def _about(queries: np.ndarray, chunks: np.ndarray, metric: str) -> tuple[np.ndarray, np.ndarray | float]:
    """Scores (squared for distances) by one matrix product, and how far off they may be."""
    if metric == "cosine":
        return unit(queries) @ unit(chunks).T, MARGIN
    sizes = (queries * queries).sum(axis=1)[:, None] + (chunks * chunks).sum(axis=1)[None, :]
    return sizes - 2 * (queries @ chunks.T), MARGIN * (sizes + 1)


def _scores(queries: np.ndarray, chunks: np.ndarray, metric: str) -> np.ndarray:
    """Score of each row of queries with the same row of chunks, whatever stands beside it."""
    if metric == "cosine":
        return (unit(queries) * unit(chunks)).sum(axis=1)
    return np.sqrt(((chunks - queries) ** 2).sum(axis=1))


def _keep_best(rows: dict[str, np.ndarray], ranking: Ranking) -> dict[str, np.ndarray]:
    """Best ``k`` per query (after the best row per episode); ties go to the lower ids."""
    key = ranking.best_first * rows["score"]
    if ranking.per_episode:
        order = np.lexsort((key, rows["episode"], rows["query"]))
        rows = {name: values[order] for name, values in rows.items()}
        first = np.ones(len(order), dtype=bool)
        first[1:] = (np.diff(rows["query"]) != 0) | (np.diff(rows["episode"]) != 0)
        rows = {name: values[first] for name, values in rows.items()}
        key = ranking.best_first * rows["score"]
    order = np.lexsort((rows["chunk"], rows["episode"], key, rows["query"]))
    rows = {name: values[order] for name, values in rows.items()}
    starts = np.flatnonzero(np.diff(rows["query"], prepend=-1))
    place = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
    return {name: values[place < ranking.k] for name, values in rows.items()}


def _candidates(
    queries: _Queries, picked: np.ndarray, vectors, episodes, chunks, ranking: Ranking
) -> dict[str, np.ndarray]:
    """Rows of one tile that may be among the best of the picked queries."""
    about, margin = _about(queries.vectors[picked], vectors, ranking.metric)
    key = ranking.best_first * about
    usable = ~np.isnan(key)
    if ranking.threshold is not None:
        bound = ranking.best_first * ranking.threshold if ranking.metric == "cosine" else ranking.threshold**2
        usable &= key <= bound + margin
    if ranking.skip_own_episode:
        usable &= queries.own_episode[picked][:, None] != episodes[None, :]
    low, high = np.where(usable, key - margin, np.inf), np.where(usable, key + margin, np.inf)
    if ranking.per_episode:
        distinct, inverse = np.unique(episodes, return_inverse=True)
        order = np.argsort(inverse, kind="stable")
        starts = np.searchsorted(inverse[order], np.arange(len(distinct)))
        own = np.minimum.reduceat(high[:, order], starts, axis=1)
        keep = (low < np.inf) & (low <= own[:, inverse])
    else:
        own, keep = high, low < np.inf
    if own.shape[1] > ranking.k:
        # Everything that may be as good as the k-th best, so ties are all kept.
        keep &= low <= np.partition(own, ranking.k - 1, axis=1)[:, ranking.k - 1 : ranking.k]
    q, c = np.nonzero(keep)
    return _keep_best(_scored_pairs(queries, picked, q, c, vectors, episodes, chunks, ranking), ranking)


def _scored_pairs(
    queries: _Queries, picked: np.ndarray, q: np.ndarray, c: np.ndarray, vectors, episodes, chunks, ranking: Ranking
) -> dict[str, np.ndarray]:
    """Rows of these pairs of picked queries and chunks with their exact scores, where those may count."""
    score = np.empty(len(q))
    for first in range(0, len(q), PAIRS_TOGETHER):
        some = slice(first, first + PAIRS_TOGETHER)
        score[some] = _scores(queries.vectors[picked[q[some]]], vectors[c[some]], ranking.metric)
    good = ~np.isnan(score)
    if ranking.threshold is not None:
        good &= score > ranking.threshold if ranking.metric == "cosine" else score < ranking.threshold
    q, c = q[good], c[good]
    chunk = np.zeros(len(c), np.int64) if ranking.per_episode else chunks[c]
    return {"query": picked[q], "episode": episodes[c], "chunk": chunk, "score": score[good]}


def _floors(queries: _Queries, best: dict[str, np.ndarray], ranking: Ranking) -> np.ndarray:
    """The least cosine that may still be among the best of each query; the threshold where fewer than ``k`` rows are known."""
    bound = -np.inf if ranking.threshold is None else ranking.threshold
    found = np.bincount(best["query"], minlength=len(queries.ids))
    floors, full = np.where(queries.directed, bound, np.inf), found >= ranking.k
    floors[full] = best["score"][np.cumsum(found)[full] - 1]
    return floors


def _above(
    queries: _Queries, picked: np.ndarray, floors: np.ndarray, directions, vectors, episodes, chunks, ranking: Ranking
) -> list[dict[str, np.ndarray]]:
    """Rows of one tile that reach the floors of the picked queries; most tiles have few, so little is done per pair."""
    about = queries.directions[picked] @ directions.T
    least = (floors[picked] - _direction_margin(vectors.shape[1])).astype(np.float32)
    some = np.flatnonzero(about.max(axis=1) >= least)
    if not len(some):
        return []
    keep = about[some] >= least[some, None]
    if ranking.skip_own_episode:
        keep &= queries.own_episode[picked[some]][:, None] != episodes[None, :]
    q, c = np.divmod(np.flatnonzero(keep), keep.shape[1])
    # Where a tile has many such rows, as when better ones stand later, it is cut to the best before they are scored.
    many = np.bincount(q, minlength=len(some)) > 4 * ranking.k
    found = []
    if many.any():
        found.append(_candidates(queries, picked[some[many]], vectors, episodes, chunks, ranking))
        q, c = q[~many[q]], c[~many[q]]
    found.append(_scored_pairs(queries, picked[some], q, c, vectors, episodes, chunks, ranking))
    return found


def _positions(values: np.ndarray) -> dict[int, np.ndarray]:
    """Where each value occurs."""
    order = np.argsort(values, kind="stable")
    distinct, starts = np.unique(values[order], return_index=True)
    return dict(zip(distinct.tolist(), np.split(order, starts[1:])))


def _scan(queries: _Queries, ranking: Ranking, batches: Iterator[pa.RecordBatch]) -> dict[str, np.ndarray]:
    """Best rows over all batches of a task; what is held is bounded by queries times ``k``."""
    best = {
        "query": np.array([], np.int64), "episode": np.array([], np.int64),
        "chunk": np.array([], np.int64), "score": np.array([], np.float64),
    }
    if len(queries.ids) == 0:
        return best
    everything = np.arange(len(queries.ids))
    asked = None if queries.match is None else _positions(queries.match)
    # What a query has found bounds what is worth a closer look; the first rows of each give the bounds.
    floors, bounded = np.full(len(queries.ids), -np.inf), ranking.metric == "cosine"
    pending, waiting = [best], 0

    def merge() -> None:
        nonlocal pending, waiting, floors
        pending, waiting = [_keep_best({name: np.concatenate([p[name] for p in pending]) for name in best}, ranking)], 0
        if bounded:
            floors = _floors(queries, pending[0], ranking)

    rows_next = FIRST_TILE if bounded and asked is None else CORPUS_TILE
    for batch in batches:
        offset = 0
        while offset < batch.num_rows:
            part = batch.slice(offset, rows_next)
            offset, rows_next = offset + rows_next, min(2 * rows_next, CORPUS_TILE)
            vectors = matrix(part.column("transcript_embedding"))
            directions = _directions(vectors) if bounded else None
            episodes = part.column("episode_id").to_numpy()
            chunks = part.column("chunk_index").to_numpy()
            if asked is None:
                groups = [(everything, slice(None), len(chunks))]
            else:
                values = _positions(part.column("match").to_numpy())
                groups = [(asked[value], rows, len(rows)) for value, rows in values.items() if value in asked]
            for wanted, rows, size in groups:
                tile = vectors[rows], episodes[rows], chunks[rows]
                block = max(1, MAX_SCORES // size)
                for first in range(0, len(wanted), block):
                    picked = wanted[first : first + block]
                    known = floors[picked] > -np.inf
                    if known.any():
                        found = _above(queries, picked[known], floors, directions[rows], *tile, ranking)
                    else:
                        found = []
                    if not known.all():
                        found.append(_candidates(queries, picked[~known], *tile, ranking))
                    pending += [rows_of for rows_of in found if len(rows_of["query"])]
                    waiting += sum(len(rows_of["query"]) for rows_of in found)
                    if waiting > MAX_PENDING:
                        merge()
            if bounded and waiting and 2 * waiting >= len(pending[0]["query"]):
                merge()
    merge()
    return pending[0]


def _as_table(queries: _Queries, best: dict[str, np.ndarray]) -> pa.Table:
    return pa.Table.from_arrays(
        [
            pa.array(queries.ids[best["query"]], pa.int64()),
            pa.array(best["episode"], pa.int64()),
            pa.array(best["chunk"], pa.int64()),
            pa.array(best["score"], pa.float64()),
        ],
        schema=_ARROW_SCHEMA,
    )


def _scored(files: list[str], corpus: DataFrame, ranking: Ranking) -> DataFrame:
    """The corpus against the queries in these files."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only = _Queries.read(read_block(files[0])) if len(files) == 1 else None
        for part in held(batches):
            for file in files:
                queries = only or _Queries.read(read_block(file))
                yield from _as_table(queries, _scan(queries, ranking, iter(part))).to_batches()

    return corpus.mapInArrow(score, RESULT_SCHEMA)


def best_matches(
    queries: DataFrame,
    corpus: DataFrame,
    ranking: Ranking,
    match: str | None = None,
    max_query_bytes: int = MAX_QUERY_BYTES,
) -> Hits:
    """Best chunks or episodes of a corpus for every query.

    ``queries`` has ``query_id, query_vector`` (and ``episode_id`` where the
    ranking skips the query's own episode); ``corpus`` has ``episode_id,
    chunk_index, transcript_embedding``. With ``match``, a chunk is scored only
    for queries with the same value in that bigint column. Queries must be of one
    dimension; a chunk whose vector has another one, or a null number, matches
    nothing (``validate_embeddings`` reports such chunks).
    """
    own = F.col("episode_id") if ranking.skip_own_episode else F.lit(None)
    extra = [F.col(match).cast("bigint").alias("match")] if match else []
    asked = queries.select(
        F.col("query_id").cast("bigint").alias("query_id"),
        "query_vector",
        own.cast("bigint").alias("own_episode"),
        *extra,
    ).filter(F.col("query_vector").isNotNull())
    scanned = corpus.select(
        F.col("episode_id").cast("bigint").alias("episode_id"),
        F.col("chunk_index").cast("bigint").alias("chunk_index"),
        "transcript_embedding",
        *extra,
    ).filter(F.col("transcript_embedding").isNotNull())
    asked = fixed(asked)
    length = F.size("query_vector")
    size = asked.agg(
        F.count("*").alias("rows"), F.sum(length).alias("numbers"), F.max(length).alias("dim"), F.min(length).alias("least")
    ).first()
    if size["least"] != size["dim"]:
        raise ValueError("query vectors must be of one dimension")
    vector = F.col("transcript_embedding")
    fits = (F.size(vector) == (size["dim"] or 0)) & F.forall(vector, lambda x: x.isNotNull())
    blocks = max(1, -(-(size["numbers"] or 0) * 8 // max(max_query_bytes, 1)))
    found = _scored(write_blocks(asked, blocks, "query_id", "queries"), scanned.filter(fits), ranking)
    return Hits(_final(found, ranking), size["rows"] * ranking.k <= SMALL_HITS)


def rescored(pairs: DataFrame) -> DataFrame:
    """Cosine of ``query_vector`` and ``vector`` in each row (``query_id, episode_id, chunk_index``), where there is one."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.list_value_length(batch.column("vector")).to_numpy(zero_copy_only=False)
            for size in np.unique(sizes):
                part = batch.take(pa.array(np.flatnonzero(sizes == size)))
                scores = _scores(matrix(part.column("query_vector")), matrix(part.column("vector")), "cosine")
                columns = [part.column(c) for c in ("query_id", "episode_id", "chunk_index")]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(scores)], schema=_ARROW_SCHEMA)

    columns = pairs.select("query_id", "episode_id", "chunk_index", "query_vector", "vector")
    return columns.mapInArrow(score, RESULT_SCHEMA).filter(~F.isnan("score"))


def best_in_episode(queries: DataFrame, embeddings: DataFrame, k: int) -> DataFrame:
    """The chunks of its own episode most like each query (``query_id, episode_id, query_vector``), ranked.

    Queries and chunks meet by episode, so no other episode's chunks are scored; a
    chunk without a vector of the query's size, or with null numbers, matches nothing.
    """
    numbers = lambda v: F.forall(v, lambda x: x.isNotNull())
    asked = queries.select(
        F.col("query_id").cast("bigint").alias("query_id"), F.col("episode_id").cast("bigint").alias("episode_id"),
        F.col("query_vector").cast("array<double>").alias("query_vector"),
    )
    chunks = embeddings.select(
        F.col("episode_id").cast("bigint").alias("episode_id"), F.col("chunk_index").cast("bigint").alias("chunk_index"),
        F.col("transcript_embedding").cast("array<double>").alias("vector"),
    )
    pairs = asked.join(chunks, "episode_id").filter(
        (F.size("query_vector") == F.size("vector")) & numbers(F.col("query_vector")) & numbers(F.col("vector"))
    )

    scored = rescored(pairs)
    return top_n(scored, ["query_id"], [F.col("score").desc(), F.col("chunk_index")], k, salt_by=["chunk_index"])


def _final(found: DataFrame, ranking: Ranking) -> DataFrame:
    """Merge the tasks' best rows; each task sent at most ``k`` per query."""
    best = F.max if ranking.metric == "cosine" else F.min
    if ranking.per_episode:
        found = found.groupBy("query_id", "episode_id").agg(best("score").alias("score"))
    better = F.col("score").desc() if ranking.metric == "cosine" else F.col("score").asc()
    key = ["episode_id"] if ranking.per_episode else ["episode_id", "chunk_index"]
    return top_n(found, ["query_id"], [better, *[F.col(c) for c in key]], ranking.k, salt_by=key)
