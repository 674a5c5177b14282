"""Transcript chunks and their vectors."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from earshot.functions.grouping import mark_existing
from earshot.functions.once import compute_once
from earshot.functions.text import SPACE, is_blank, strip
from earshot.session import fixed

Embedder = Callable[[DataFrame], DataFrame]


def gate_transcripts(df: DataFrame, min_length: int = 100) -> DataFrame:
    """Add ``reject_reason``: a transcript needs ``min_length`` characters after stripping."""
    text = F.col("transcript_text")
    short = F.length(strip(text)) < min_length
    return df.withColumn("reject_reason", F.when(is_blank(text), "empty").when(short, "too short"))


def space_tokens(text: Column) -> Column:
    """Tokens between runs of white space; a model's own tokenizer can stand in."""
    return F.filter(F.split(text, rf"(?U){SPACE}+"), lambda t: t != "")


def chunk_transcripts(
    df: DataFrame, size: int = 512, overlap: int = 256, sep: str = " "
) -> tuple[DataFrame, DataFrame]:
    """Overlapping windows over ``tokens`` (``episode_id, tokens array<string>``).

    Windows start every ``size - overlap`` tokens for as long as a token is
    left, so short tails stay; ``end_token`` is the nominal end and may lie
    behind the last token. Episodes without tokens come back as rejected.
    """
    if size <= 0 or not 0 <= overlap < size:
        raise ValueError("overlap must be at least 0 and smaller than size")
    stride = size - overlap
    empty = F.coalesce(F.size("tokens") <= 0, F.lit(True))
    rejected = df.filter(empty).select("episode_id").withColumn("reject_reason", F.lit("empty"))
    # The guard comes first: sequence(0, -1) would count down.
    last = F.when(~empty, F.floor((F.size("tokens") - 1) / stride).cast("int"))

    def window(index: Column) -> Column:
        start = index * stride
        part = F.slice("tokens", start + 1, F.lit(size))
        return F.struct(
            index.alias("chunk_index"),
            F.array_join(part, sep).alias("chunk_text"),
            F.size(part).alias("token_count"),
            start.alias("start_token"),
            (start + size).alias("end_token"),
        )

    # Windows are cut before the explode, so no chunk row carries the whole token list.
    # An empty episode has no windows and drops out by itself; a filter on the tokens
    # would be pushed down and tokenise once more.
    windows = F.transform(F.sequence(F.lit(0), last), window)
    return df.select("episode_id", F.inline(windows)), rejected


def hashing_embedder(dim: int = 1536) -> Embedder:
    """Stand-in embedder: hashed word counts scaled to unit length, all in the JVM."""

    def embed(chunks: DataFrame) -> DataFrame:
        from pyspark.ml.feature import HashingTF, Normalizer
        from pyspark.ml.functions import vector_to_array

        worded = chunks.withColumn("_words", space_tokens(F.col("chunk_text")))
        counted = HashingTF(inputCol="_words", outputCol="_counts", numFeatures=dim).transform(worded)
        scaled = Normalizer(inputCol="_counts", outputCol="_unit").transform(counted)
        vector = vector_to_array("_unit", "float32").alias("transcript_embedding")
        return scaled.select(*chunks.columns, vector)

    return embed


def batch_embedder(
    make_model: Callable[[], Callable[[np.ndarray], np.ndarray]], batch_size: int = 64
) -> Embedder:
    """Embedder around a model that takes an array of texts and gives a row of numbers for each.

    ``make_model`` is called once in every Python worker. A batch that raises, as with a request that is
    refused, is taken text by text; what raises alone has no vector.
    """

    def make_predict():
        model = make_model()

        def rows(texts: np.ndarray) -> np.ndarray:
            return np.asarray(model(texts), np.float32).reshape(len(texts), -1)

        def one(text: np.ndarray) -> np.ndarray | None:
            try:
                return rows(text)[0]
            except Exception:
                return None

        def predict(texts: np.ndarray) -> np.ndarray:
            try:
                return rows(texts)
            except Exception:
                single = [one(texts[i : i + 1]) for i in range(len(texts))]
                dim = next((len(v) for v in single if v is not None), 1)
                return np.stack([np.full(dim, np.nan, np.float32) if v is None else v for v in single])

        return predict

    def embed(chunks: DataFrame) -> DataFrame:
        from pyspark.ml.functions import predict_batch_udf

        vector = predict_batch_udf(make_predict, return_type=T.ArrayType(T.FloatType()), batch_size=batch_size)
        found = chunks.withColumn("_vector", vector(F.col("chunk_text")))
        whole = ~F.exists("_vector", lambda x: F.isnan(x))
        return found.select(*chunks.columns, F.when(whole, F.col("_vector")).alias("transcript_embedding"))

    return embed


def embed_chunks(chunks: DataFrame, embedder: Embedder) -> tuple[DataFrame, DataFrame]:
    """One vector per chunk; a chunk that gets none takes its whole episode out.

    The embedder gives each chunk row back with a ``transcript_embedding``,
    NULL where it failed (a model plugs in through ``mapInPandas``). Blank
    chunks are not offered to it. Chunks are spread evenly first, because a
    long transcript leaves all of its chunks in one partition; the vectors are
    written down, because both results need them and a model is called once.
    """
    spread = compute_once(
        chunks.repartition("episode_id", "chunk_index"), {"_blank": is_blank(F.col("chunk_text"))}
    )
    none = F.lit(None).cast("array<float>")
    offered = embedder(spread.filter(~F.col("_blank")).drop("_blank"))
    refused = spread.filter("_blank").drop("_blank").withColumn("transcript_embedding", none)
    embedded = fixed(offered.unionByName(refused))
    failed = (
        embedded.filter(F.col("transcript_embedding").isNull())
        .groupBy("episode_id")
        .agg(F.count("*").alias("failed_chunks"))
    )
    return embedded.join(failed, "episode_id", "left_anti"), failed


def validate_embeddings(chunks: DataFrame, dim: int = 1536, episodes: DataFrame | None = None) -> DataFrame:
    """Per episode whether all its chunks have a vector of ``dim`` numbers.

    With ``episodes`` given, an episode without any chunk is invalid as well.
    """
    fits = F.coalesce(F.size("transcript_embedding") == dim, F.lit(False))
    verdict = chunks.groupBy("episode_id").agg(
        F.count("*").alias("chunks"), F.bool_and(fits).alias("is_valid")
    )
    if episodes is None:
        return verdict
    return (
        episodes.select("episode_id")
        .join(verdict, "episode_id", "left")
        .select(
            "episode_id",
            F.coalesce("chunks", F.lit(0)).alias("chunks"),
            F.coalesce("is_valid", F.lit(False)).alias("is_valid"),
        )
    )


def keep_valid(chunks: DataFrame, verdict: DataFrame) -> DataFrame:
    """Chunks of the episodes that passed."""
    return chunks.join(verdict.filter("is_valid").select("episode_id"), "episode_id", "left_semi")


_COLUMNS = ["episode_id", "chunk_index", "chunk_text", "transcript_embedding"]


def storable_embeddings(new: DataFrame, episodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Chunks of known episodes, and the ids of the unknown ones."""
    known = mark_existing(new.select(*_COLUMNS), episodes, ["episode_id"], "_known")
    return known.filter("_known").drop("_known"), known.filter("not _known").select("episode_id").distinct()


def replace_embeddings(
    new: DataFrame, current: DataFrame, episodes: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Embedding table where the episodes in ``new`` have only their new chunks.

    Chunks of unknown episodes are not stored; their ids come back as second
    frame. The result is published as one new version, so readers see the old
    or the new chunks of an episode and never a mix.
    """
    columns = _COLUMNS
    storable, unknown = storable_embeddings(new, episodes)
    touched = storable.select("episode_id").distinct()
    kept = current.select(*columns).join(touched, "episode_id", "left_anti")
    return kept.unionByName(storable), unknown
