"""Dashboard aggregates.

Podcast names are not unique and the dashboard groups by name. Rows are counted
per podcast id first and merged by name afterwards: the counts that meet at a
popular name are already one row per podcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from earshot.functions.grouping import running_total
from earshot.functions.text import count_words_by_space, title_words


def episodes_with_podcast(episodes: DataFrame, podcasts: DataFrame) -> DataFrame:
    """All columns of episodes and their podcast; the podcast's own are prefixed where both have them."""
    about = podcasts.withColumnsRenamed(
        {c: f"podcast_{c}" for c in podcasts.columns if c in episodes.columns and c != "podcast_id"}
    )
    return episodes.join(about, "podcast_id")


def content_counts(episodes: DataFrame, podcasts: DataFrame, by: str | None = None) -> DataFrame:
    """Podcasts, episodes and transcripts, in total or per podcast name."""
    is_transcribed = F.count_if(F.col("transcribed"))
    if by is None:
        zero = lambda name: F.lit(0).cast("bigint").alias(name)
        parts = podcasts.agg(F.count("*").alias("podcasts"), zero("episodes"), zero("transcripts")).unionByName(
            episodes.agg(zero("podcasts"), F.count("*").alias("episodes"), is_transcribed.alias("transcripts"))
        )
        return parts.agg(*[F.sum(c).alias(c) for c in ("podcasts", "episodes", "transcripts")])
    if by != "podcast_name":
        raise ValueError("by must be podcast_name")
    per_id = episodes.groupBy("podcast_id").agg(
        F.count("*").alias("episodes"), is_transcribed.alias("transcripts")
    )
    return (
        podcasts.select("podcast_id", "podcast_name")
        .join(per_id, "podcast_id", "left")
        .groupBy("podcast_name")
        .agg(
            F.count("*").alias("podcasts"),
            F.coalesce(F.sum("episodes"), F.lit(0)).alias("episodes"),
            F.coalesce(F.sum("transcripts"), F.lit(0)).alias("transcripts"),
        )
    )


def episodes_per_podcast(episodes: DataFrame, podcasts: DataFrame) -> DataFrame:
    """Episodes per podcast name, podcasts without any included."""
    per_id = episodes.groupBy("podcast_id").agg(F.count("*").alias("_episodes"))
    return (
        podcasts.select("podcast_id", "podcast_name")
        .join(per_id, "podcast_id", "left")
        .groupBy("podcast_name")
        .agg(F.coalesce(F.sum("_episodes"), F.lit(0)).alias("episode_count"))
    )


def _named_topics(topics: DataFrame) -> DataFrame:
    return topics.select("topic_id", title_words(F.lower("topic_name")).alias("topic_name"))


def _episodes_per_name(
    bridge: DataFrame, names: DataFrame, key: str, name: str, episodes: DataFrame, podcasts: DataFrame
) -> DataFrame:
    """Distinct episodes per podcast name and linked name.

    An episode has one podcast, so distinct episodes per podcast id add up. Rows that repeat
    stand in one part with their episode, so they are dropped there and plain counts leave it.
    """
    linked = bridge.select("episode_id", key).join(names, key).select("episode_id", name)
    shows = episodes.select("episode_id", "podcast_id")
    per_id = (
        linked.repartition("episode_id").distinct()
        .join(shows.repartition("episode_id").distinct(), "episode_id")
        .groupBy("podcast_id", name)
        .agg(F.count("*").alias("_episodes"))
    )
    return (
        per_id.join(podcasts.select("podcast_id", "podcast_name"), "podcast_id")
        .groupBy("podcast_name", name)
        .agg(F.sum("_episodes").alias("episode_count"))
    )


def _first_n(counts: DataFrame, name: str, n: int) -> DataFrame:
    best = Window.partitionBy("podcast_name").orderBy(F.col("episode_count").desc(), name)
    return counts.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= n)


def topics_per_podcast(
    episodes: DataFrame, podcasts: DataFrame, topics: DataFrame, episode_topics: DataFrame
) -> DataFrame:
    """Distinct episodes per podcast name and topic; topics match without regard to case."""
    counts = _episodes_per_name(
        episode_topics, _named_topics(topics), "topic_id", "topic_name", episodes, podcasts
    )
    return counts.orderBy("podcast_name", F.col("episode_count").desc(), "topic_name")


def top_topics(
    episodes: DataFrame, podcasts: DataFrame, topics: DataFrame, episode_topics: DataFrame, n: int = 3
) -> DataFrame:
    """The ``n`` most frequent topics per podcast name."""
    counts = _episodes_per_name(
        episode_topics, _named_topics(topics), "topic_id", "topic_name", episodes, podcasts
    )
    return _first_n(counts, "topic_name", n).orderBy("podcast_name", "rank")


def published_timeline(episodes: DataFrame, podcasts: DataFrame) -> DataFrame:
    """Dated episodes by podcast name and date."""
    return (
        episodes.filter(F.col("published_at").isNotNull())
        .select("episode_id", "podcast_id", "published_at", "episode_title")
        .join(podcasts.select("podcast_id", "podcast_name"), "podcast_id")
        .select("podcast_name", "published_at", "episode_title", "episode_id")
        .orderBy("podcast_name", "published_at", "episode_id")
    )


def cumulative_published(episodes: DataFrame, podcasts: DataFrame, as_of: Column) -> DataFrame:
    """Running episode count per podcast name over the calendar month before ``as_of``."""
    recent = episodes.filter(F.col("published_at") >= as_of - F.expr("INTERVAL 1 MONTH"))
    named = recent.select("episode_id", "podcast_id", "published_at", "episode_title").join(
        podcasts.select("podcast_id", "podcast_name"), "podcast_id"
    )
    counted = running_total(
        named.drop("podcast_id"),
        ["podcast_name"],
        [F.col("published_at"), F.col("episode_id")],
        F.lit(1).cast("bigint"),
        "cumulative_episodes",
    )
    return counted.orderBy("podcast_name", "cumulative_episodes")


def _links_per_episode(bridge: DataFrame, key: str, out: str) -> DataFrame:
    return bridge.groupBy("episode_id").agg(F.count_distinct(key).alias(out))


def _newest_first() -> list[Column]:
    return [F.col("podcast_name"), F.col("published_at").desc_nulls_first(), F.col("episode_id")]


def topics_per_episode(episodes: DataFrame, podcasts: DataFrame, episode_topics: DataFrame) -> DataFrame:
    """Distinct topics per episode, none included; newest first within a podcast name."""
    counts = _links_per_episode(episode_topics, "topic_id", "topic_count")
    return (
        episodes.select("episode_id", "podcast_id", "episode_title", "published_at", "transcribed")
        .join(podcasts.select("podcast_id", "podcast_name"), "podcast_id")
        .join(counts, "episode_id", "left")
        .select(
            "podcast_name", "episode_id", "episode_title", "published_at", "transcribed",
            F.coalesce("topic_count", F.lit(0)).alias("topic_count"),
        )
        .orderBy(*_newest_first())
    )


def _episode_facts(
    episodes: DataFrame, podcasts: DataFrame, episode_topics: DataFrame, episode_speakers: DataFrame
) -> DataFrame:
    """Episodes with both counts; each bridge is counted alone, so they do not multiply."""
    return (
        episodes.select("episode_id", "podcast_id", "episode_title", "published_at", "transcribed", "uploaded_at")
        .join(podcasts.select("podcast_id", "podcast_name"), "podcast_id")
        .join(_links_per_episode(episode_topics, "topic_id", "topic_count"), "episode_id", "left")
        .join(_links_per_episode(episode_speakers, "speaker_id", "speaker_count"), "episode_id", "left")
        .withColumn("topic_count", F.coalesce("topic_count", F.lit(0)))
        .withColumn("speaker_count", F.coalesce("speaker_count", F.lit(0)))
    )


def episode_details(
    episodes: DataFrame, podcasts: DataFrame, episode_topics: DataFrame, episode_speakers: DataFrame
) -> DataFrame:
    """Topic and speaker counts per episode; newest first within a podcast name."""
    facts = _episode_facts(episodes, podcasts, episode_topics, episode_speakers)
    return facts.select(
        "podcast_name", "episode_id", "episode_title", "published_at", "transcribed", "uploaded_at",
        "topic_count", "speaker_count",
    ).orderBy(*_newest_first())


def topic_frequency(
    episodes: DataFrame, podcasts: DataFrame, topics: DataFrame, episode_topics: DataFrame, n: int | None = None
) -> DataFrame:
    """Distinct episodes per topic within a podcast name, most frequent first; ``n`` keeps the top."""
    if n is not None:
        return top_topics(episodes, podcasts, topics, episode_topics, n)
    return topics_per_podcast(episodes, podcasts, topics, episode_topics)


def speaker_frequency(
    episodes: DataFrame, podcasts: DataFrame, speakers: DataFrame, episode_speakers: DataFrame, n: int | None = None
) -> DataFrame:
    """Distinct episodes per speaker within a podcast name, most frequent first; ``n`` keeps the top."""
    names = speakers.select("speaker_id", "speaker_name")
    counts = _episodes_per_name(episode_speakers, names, "speaker_id", "speaker_name", episodes, podcasts)
    if n is not None:
        return _first_n(counts, "speaker_name", n).orderBy("podcast_name", "rank")
    return counts.orderBy("podcast_name", F.col("episode_count").desc(), "speaker_name")


def podcast_stats(
    episodes: DataFrame, podcasts: DataFrame, episode_topics: DataFrame, episode_speakers: DataFrame
) -> DataFrame:
    """Episode totals and mean topics and speakers per podcast name.

    A podcast without episodes has zero counts and NULL means.
    """
    facts = _episode_facts(episodes, podcasts, episode_topics, episode_speakers)
    stats = facts.groupBy("podcast_name").agg(
        F.count("*").alias("total_episodes"),
        F.count_if(F.col("transcribed")).alias("transcribed_episodes"),
        F.count_if(~F.col("transcribed")).alias("untranscribed_episodes"),
        F.avg("topic_count").alias("avg_topics_per_episode"),
        F.avg("speaker_count").alias("avg_speakers_per_episode"),
    )
    counts = ["total_episodes", "transcribed_episodes", "untranscribed_episodes"]
    return (
        podcasts.select("podcast_name")
        .distinct()
        .join(stats, "podcast_name", "left")
        .select(
            "podcast_name",
            *[F.coalesce(c, F.lit(0)).alias(c) for c in counts],
            "avg_topics_per_episode",
            "avg_speakers_per_episode",
        )
    )


def word_counts(transcripts: DataFrame) -> DataFrame:
    """Blanks plus one per transcript; transcripts without text have no count."""
    return transcripts.select(
        "podcast_id", "episode_id", count_words_by_space(F.col("transcript_text")).alias("word_count")
    )


def transcript_length_series(episodes: DataFrame, transcripts: DataFrame) -> DataFrame:
    """Word counts of dated episodes over time; ids are compared as text, unmatched episodes left out."""
    counts = word_counts(transcripts).filter(F.col("word_count").isNotNull()).select(
        F.col("episode_id").cast("string").alias("_key"), "word_count"
    )
    return (
        episodes.select("episode_id", "episode_title", "published_at")
        .withColumn("_key", F.col("episode_id").cast("string"))
        .join(counts, "_key")
        .drop("_key")
        .orderBy("published_at", "episode_id")
    )


def word_count_summary(transcripts: DataFrame) -> DataFrame:
    """Transcripts and their smallest, largest and rounded mean word count per podcast."""
    return word_counts(transcripts).groupBy("podcast_id").agg(
        F.count("word_count").alias("transcripts"),
        F.min("word_count").alias("min_words"),
        F.max("word_count").alias("max_words"),
        F.rint(F.avg("word_count")).cast("bigint").alias("avg_words"),
    )
