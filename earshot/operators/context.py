"""Chat context and facet filters."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from earshot.functions.grouping import top_n
from earshot.functions.once import let

# Layout of the context texts and the words that ask for similar episodes.
CHUNK_LINE = "[Chunk %d]: %s"
CHUNK_SEPARATOR = "\\n\\n"
SIMILAR_HEADING = "\n\n**Similar Episodes Available:**\n"
SIMILAR_LINE = "- %s (%s) - Similarity: %s%%\n"
SIMILAR_WORDS = ["similar", "like this", "recommend", "related episodes"]


def chunk_context(hits: DataFrame, queries: DataFrame, top_k: int = 5) -> DataFrame:
    """One context text per query from its ranked chunks; no chunks give the empty text.

    ``hits`` has ``query_id, rank, chunk_index, chunk_text`` with ranks from 1.
    """
    line = F.format_string(CHUNK_LINE, "chunk_index", "chunk_text")
    joined = (
        hits.filter(F.col("rank") <= top_k)
        .select("query_id", "rank", line.alias("_line"))
        .groupBy("query_id")
        .agg(F.expr(f"listagg(_line, '{CHUNK_SEPARATOR}') WITHIN GROUP (ORDER BY rank)").alias("context"))
    )
    return (
        queries.select("query_id")
        .join(joined, "query_id", "left")
        .withColumn("context", F.coalesce("context", F.lit("")))
    )


def _percent(score: Column) -> Column:
    """Per cent with one decimal, rounded by the exact binary value (ties to the even digit).

    The value is cut into a short and a rest part; twenty times each is exact, so
    the sign of the distance to a midpoint between two tenths is.
    """

    def rounded(value: Column) -> Column:
        short = value.cast("float").cast("double")
        rest = value - short
        above = lambda midpoint: (short * 20 - midpoint) + rest * 20
        near = F.bround(value * 10).cast("long")
        odd = near % 2 != 0
        up, down = above(near * 2 + 1), above(near * 2 - 1)
        tenths = F.when((up > 0) | ((up == 0) & odd), near + 1).when((down < 0) | ((down == 0) & odd), near - 1).otherwise(near)
        sign, size = F.when(tenths < 0, "-").otherwise(""), F.abs(tenths)
        return F.format_string("%s%d.%d", sign, F.floor(size / 10), size % 10)

    return let(score.cast("double") * 100, rounded)


def similar_context(similar: DataFrame, queries: DataFrame, top_k: int = 5) -> DataFrame:
    """Recommendation list per query in rank order; no neighbours give the empty text."""
    line = F.format_string(SIMILAR_LINE, "episode_title", "podcast_name", _percent(F.col("similarity_score")))
    joined = (
        similar.filter(F.col("rank") <= top_k)
        .select("query_id", "rank", line.alias("_line"))
        .groupBy("query_id")
        .agg(F.expr("listagg(_line, '') WITHIN GROUP (ORDER BY rank)").alias("_lines"))
    )
    return (
        queries.select("query_id")
        .join(joined, "query_id", "left")
        .withColumn("similar_episodes", F.coalesce(F.concat(F.lit(SIMILAR_HEADING), F.col("_lines")), F.lit("")))
        .drop("_lines")
    )


def asks_for_similar(message: Column) -> Column:
    """Whether a message asks for other episodes, in any case."""
    text = F.lower(message)
    asked = F.lit(False)
    for word in SIMILAR_WORDS:
        asked = asked | text.contains(word)
    return F.coalesce(asked, F.lit(False))


def with_context(messages: DataFrame, chunks: DataFrame, similar: DataFrame) -> DataFrame:
    """Messages (``query_id, message``) with both contexts; the list only where it is asked for."""
    wants = F.col("wants_similar")
    return (
        messages.withColumn("wants_similar", asks_for_similar(F.col("message")))
        .join(chunks.select("query_id", "context"), "query_id", "left")
        .join(similar.select("query_id", "similar_episodes"), "query_id", "left")
        .withColumn("context", F.coalesce("context", F.lit("")))
        .withColumn(
            "similar_episodes", F.when(wants, F.coalesce("similar_episodes", F.lit(""))).otherwise("")
        )
    )


def recent_turns(conversations: DataFrame, n: int = 10) -> DataFrame:
    """The last ``n`` turns of each conversation, numbered in their original order."""
    last = top_n(conversations, ["conv_id"], [F.col("turn").desc()], n, salt_by=["turn"], rank="_back")
    position = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn"))
    return last.withColumn("position", position).drop("_back")


def chat_request(conversations: DataFrame, messages: DataFrame, n: int = 10) -> DataFrame:
    """Recent turns followed by the current message (``conv_id, message``), in order."""
    history = recent_turns(conversations, n).select("conv_id", "position", "role", "text")
    current = messages.select(
        "conv_id", F.lit(n + 1).alias("position"), F.lit("user").alias("role"), F.col("message").alias("text")
    )
    return history.unionByName(current).orderBy("conv_id", "position")


def filter_episodes(
    tables: dict[str, DataFrame],
    topics: Sequence[str] | None = None,
    speakers: Sequence[str] | None = None,
    podcasts: Sequence[str] | None = None,
    since: datetime | None = None,
    until: datetime | None = None,
) -> DataFrame:
    """Episodes that meet every given facet; within a facet any of the values will do.

    Each facet is a set of ids, so an episode never comes back twice.
    """
    found = tables["episode"]
    if since is not None:
        found = found.filter(F.col("published_at") >= F.lit(since).cast("timestamp_ntz"))
    if until is not None:
        found = found.filter(F.col("published_at") <= F.lit(until).cast("timestamp_ntz"))
    if podcasts:
        named = tables["podcast"].filter(F.col("podcast_name").isin(*podcasts)).select("podcast_id")
        found = found.join(named, "podcast_id", "left_semi")
    for values, names, bridge, key, name in (
        (topics, "topics", "episode_topics", "topic_id", "topic_name"),
        (speakers, "speakers", "episode_speakers", "speaker_id", "speaker_name"),
    ):
        if values:
            wanted = tables[names].filter(F.col(name).isin(*values)).select(key)
            linked = tables[bridge].join(wanted, key, "left_semi").select("episode_id").distinct()
            found = found.join(linked, "episode_id", "left_semi")
    return found.select("episode_id", "podcast_id", "episode_title", "published_at")
