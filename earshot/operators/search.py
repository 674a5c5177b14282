"""Semantic search for a whole table of queries."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.functions.grouping import mark_existing
from earshot.functions.text import sentence_start
from earshot.operators.scoring import Hits, Ranking, best_in_episode, best_matches, matrix, unit


def _with_episode(hits: Hits, episodes: DataFrame, podcasts: DataFrame) -> DataFrame:
    about = episodes.select("episode_id", "episode_title", "published_at", "podcast_id")
    found = hits.hinted(about.join(hits.hinted(), "episode_id"))
    return podcasts.select("podcast_id", "podcast_name").join(found, "podcast_id")


def search_chunks(
    queries: DataFrame,
    embeddings: DataFrame,
    episodes: DataFrame,
    podcasts: DataFrame,
    limit: int = 5,
    threshold: float = 0.5,
    metric: str = "cosine",
    **options,
) -> DataFrame:
    """Best chunks per query above ``threshold``, with episode, podcast and trimmed text.

    Ranking reads ids and vectors only; texts and names are fetched for the hits.
    Every chunk is taken to belong to a stored episode (``replace_embeddings``
    stores no others).
    With ``metric="l2"`` the score is a distance and ``threshold`` its upper bound
    (``None`` for no bound).
    """
    hits = best_matches(queries, embeddings, Ranking(limit, metric, threshold), **options)
    # Names first: with them a hit is still a short row, with its text it is not.
    found = hits.hinted(_with_episode(hits, episodes, podcasts))
    texts = embeddings.select("episode_id", "chunk_index", "chunk_text")
    return (
        texts.join(found, ["episode_id", "chunk_index"])
        .withColumn("chunk_text", sentence_start(F.col("chunk_text")))
        .select(
            "query_id", "rank", "episode_id", "episode_title", "podcast_name", "published_at",
            "chunk_index", "chunk_text", F.col("score").alias("similarity" if metric == "cosine" else "distance"),
        )
    )


def search_episodes(
    queries: DataFrame,
    embeddings: DataFrame,
    episodes: DataFrame,
    podcasts: DataFrame,
    top_k: int = 5,
    metric: str = "cosine",
    **options,
) -> DataFrame:
    """Best episodes per query, scored by their best chunk."""
    hits = best_matches(queries, embeddings, Ranking(top_k, metric, per_episode=True), **options)
    return _episode_hits(hits, episodes, podcasts)


def _episode_hits(hits: Hits, episodes: DataFrame, podcasts: DataFrame) -> DataFrame:
    return _with_episode(hits, episodes, podcasts).select(
        "query_id", "rank", "episode_id", "episode_title", "published_at", "podcast_id", "podcast_name",
        F.col("score").alias("similarity_score"),
    )


def search_within(queries: DataFrame, embeddings: DataFrame, top_k: int = 5) -> DataFrame:
    """Best chunks of the episode each query asks about (``query_id, episode_id, query_vector``)."""
    hits = best_in_episode(queries, embeddings, top_k)
    texts = embeddings.select("episode_id", "chunk_index", "chunk_text")
    return texts.join(hits, ["episode_id", "chunk_index"]).select(
        "query_id", "rank", "episode_id", "chunk_index", "chunk_text", F.col("score").alias("similarity_score")
    )


def anchors(embeddings: DataFrame, ids: DataFrame) -> DataFrame:
    """The first chunk's vector of each asked episode, as a query table."""
    wanted = embeddings.join(ids.select("episode_id").distinct(), "episode_id", "left_semi")
    vector = F.min_by("transcript_embedding", "chunk_index").alias("query_vector")
    return wanted.groupBy("episode_id").agg(vector).withColumn("query_id", F.col("episode_id"))


def similar_episodes(
    embeddings: DataFrame,
    episodes: DataFrame,
    podcasts: DataFrame,
    ids: DataFrame,
    top_k: int = 5,
    metric: str = "cosine",
    **options,
) -> DataFrame:
    """Episodes most like each asked episode (``query_id``), itself left out.

    An episode without vectors has no neighbours.
    """
    asked = anchors(embeddings, ids)
    ranking = Ranking(top_k, metric, per_episode=True, skip_own_episode=True)
    hits = best_matches(asked, embeddings, ranking, **options)
    return _episode_hits(hits, episodes, podcasts)


def train_cells(embeddings: DataFrame, n_cells: int = 100, seed: int = 7) -> np.ndarray:
    """Centres of ``n_cells`` groups of unit vectors, fitted on all rows."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import Normalizer
    from pyspark.ml.functions import array_to_vector

    present = embeddings.filter(F.col("transcript_embedding").isNotNull())
    vectors = present.select(array_to_vector(F.col("transcript_embedding").cast("array<double>")).alias("raw"))
    unit = Normalizer(inputCol="raw", outputCol="features").transform(vectors)
    model = KMeans(k=n_cells, seed=seed, maxIter=10).fit(unit)
    return np.array(model.clusterCenters())


def _nearest_cells(centers: np.ndarray, column: str, n: int, names: list[str], schema: str):
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        directions = unit(centers)
        for batch in batches:
            if batch.num_rows == 0:
                continue
            near = np.nan_to_num(unit(matrix(batch.column(column))) @ directions.T, nan=-2.0)
            order = np.argsort(-near, axis=1, kind="stable")[:, :n]
            take = np.repeat(np.arange(batch.num_rows), order.shape[1])
            columns = [batch.column(name).take(pa.array(take)) for name in names]
            columns.append(pa.array(order.ravel().astype(np.int64)))
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "cell"])

    return lambda df: df.select(*names).mapInArrow(assign, schema)


def assign_cells(embeddings: DataFrame, centers: np.ndarray) -> DataFrame:
    """Corpus rows with the cell of the nearest centre."""
    names = ["episode_id", "chunk_index", "transcript_embedding"]
    present = embeddings.select(*names).filter(F.col("transcript_embedding").isNotNull())
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in present.schema) + ", cell bigint"
    return _nearest_cells(centers, "transcript_embedding", 1, names, schema)(present)


def store_cells(embeddings: DataFrame, centers: np.ndarray, path: str) -> DataFrame:
    """The corpus by cell, a folder each, read back: a search opens the folders it probes."""
    cells = assign_cells(embeddings, centers)
    cells.repartition("cell", F.pmod(F.xxhash64("episode_id", "chunk_index"), F.lit(8))).write.partitionBy("cell").parquet(path)
    return embeddings.sparkSession.read.schema(cells.schema).parquet(path)


def ann_search(
    queries: DataFrame, cells: DataFrame, centers: np.ndarray, k: int = 5, n_probe: int = 10, **options
) -> DataFrame:
    """Best chunks per query among the ``n_probe`` cells nearest to it.

    A chunk belongs to one cell, so the probes of a query never see it twice.
    ``n_probe`` equal to the number of cells gives the exact answer.
    """
    names = ["query_id", "query_vector"]
    asked = queries.select(*names)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in asked.schema) + ", cell bigint"
    probes = _nearest_cells(centers, "query_vector", n_probe, names, schema)(asked)
    # There are no more cells than centres; naming them lets the scan skip the other folders.
    probed = [row["cell"] for row in probes.select("cell").distinct().collect()]
    hits = best_matches(probes, cells.filter(F.col("cell").isin(probed)), Ranking(k), match="cell", **options)
    return hits.frame.withColumnRenamed("score", "similarity")


def embedding_coverage(episodes: DataFrame, embeddings: DataFrame) -> DataFrame:
    """Episodes with a flag telling whether they have vectors."""
    return mark_existing(episodes.select("episode_id"), embeddings, ["episode_id"], "has_embeddings")
