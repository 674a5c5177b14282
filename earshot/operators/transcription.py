"""Transcription work-list, time slices and the assembly of their results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.functions.grouping import mark_existing, ordered_concat, running_total
from earshot.functions.text import is_missing, strip


def backlog_count(episodes: DataFrame) -> DataFrame:
    """Episodes known to be untranscribed; an unknown flag does not count."""
    return episodes.agg(F.count_if(F.col("transcribed") == F.lit(False)).alias("backlog"))


def work_list(episodes: DataFrame, podcasts: DataFrame, n: int) -> DataFrame:
    """The ``n`` untranscribed episodes that were uploaded first, with their podcast.

    Only episodes of existing podcasts count, so the key check comes before the
    cut and the podcast columns are fetched for the ``n`` rows alone.
    """
    waiting = (
        episodes.filter(F.col("transcribed") == F.lit(False))
        .join(podcasts.select("podcast_id"), "podcast_id", "left_semi")
        .select("episode_id", "podcast_id", "episode_title", "audio_url", "uploaded_at")
        .orderBy(F.col("uploaded_at").asc_nulls_last(), "episode_id")
        .limit(n)
    )
    return (
        waiting.join(podcasts.select("podcast_id", "podcast_name"), "podcast_id")
        .orderBy(F.col("uploaded_at").asc_nulls_last(), "episode_id")
        .select("episode_id", "podcast_id", "podcast_name", "episode_title", "audio_url", "uploaded_at")
    )


def guard_required(work: DataFrame) -> DataFrame:
    """Add ``status``: an episode needs podcast name, title and url to be worked on."""
    missing = is_missing(F.col("podcast_name")) | is_missing(F.col("episode_title")) | is_missing(F.col("audio_url"))
    return work.withColumn("status", F.when(missing, "error").otherwise("ready"))


def plan_slices(audio: DataFrame, seconds: int = 120) -> DataFrame:
    """Cut audio of ``duration_ms`` into slices of ``seconds``; the last one may be shorter."""
    if seconds <= 0:
        raise ValueError("seconds must be positive")
    step = seconds * 1000
    last = (F.ceil(F.col("duration_ms") / step) - 1).cast("bigint")
    indexes = F.when(F.col("duration_ms") > 0, F.sequence(F.lit(0).cast("bigint"), last))
    start = F.col("slice_index") * step
    return (
        audio.withColumn("slice_index", F.explode(indexes))
        .withColumn("start_ms", start)
        .withColumn("end_ms", F.least(start + step, F.col("duration_ms")))
        .withColumn("duration_s", (F.col("end_ms") - F.col("start_ms")) / 1000.0)
    )


def stitch_segments(slices: DataFrame, segments: DataFrame) -> DataFrame:
    """Move each slice's segments behind the slices before it.

    ``slices`` has ``episode_id, slice_index, duration_s``; ``segments`` has
    ``episode_id, slice_index, pos, speaker, start_time, end_time, text``.
    Sorted by episode and start; equal starts keep slice and position order.
    """
    offsets = running_total(
        slices.select("episode_id", "slice_index", "duration_s"),
        ["episode_id"],
        [F.col("slice_index")],
        F.col("duration_s"),
        "offset_s",
        inclusive=False,
    ).drop("duration_s")
    return (
        segments.join(offsets, ["episode_id", "slice_index"])
        .select(
            "episode_id",
            (F.col("start_time") + F.col("offset_s")).alias("start_time"),
            (F.col("end_time") + F.col("offset_s")).alias("end_time"),
            "speaker",
            "text",
            "slice_index",
            "pos",
        )
        .orderBy("episode_id", "start_time", "slice_index", "pos")
    )


def assemble_text(slices: DataFrame) -> DataFrame:
    """Slice texts of an episode in order, one blank between; one failed slice fails it.

    ``slices`` has ``episode_id, slice_index, ok, text``.
    """
    state = slices.groupBy("episode_id").agg(F.bool_and(F.coalesce("ok", F.lit(False))).alias("_ok"))
    texts = ordered_concat(
        slices.withColumn("text", F.coalesce("text", F.lit(""))),
        ["episode_id"], "slice_index", "text", " ", "transcript_text",
    )
    return state.join(texts, "episode_id").select(
        "episode_id",
        F.when(F.col("_ok"), "success").otherwise("failed").alias("status"),
        F.when(F.col("_ok"), strip(F.col("transcript_text"))).alias("transcript_text"),
    )


def apply_transcribed(episodes: DataFrame, done: DataFrame) -> DataFrame:
    """Episode table with the flag set for the episodes whose output is stored."""
    marked = mark_existing(episodes, done, ["episode_id"], "_done")
    flag = F.when(F.col("_done"), F.lit(True)).otherwise(F.col("transcribed"))
    return marked.withColumn("transcribed", flag).select(*episodes.columns)


def route_outcomes(results: DataFrame) -> DataFrame:
    """Add ``route``: what the next steps do with a transcription result.

    Successes go on to analysis and embedding. A result that reports anything
    else is skipped; one that died without a report is failed. No row is lost
    and none can stop the others.
    """
    status = F.col("status")
    route = F.when(status == "success", "process").when(is_missing(status) | (status == "failed"), "failed")
    return results.withColumn("route", route.otherwise("skipped"))


def outcome_counts(routed: DataFrame) -> DataFrame:
    """Rows per route."""
    return routed.groupBy("route").agg(F.count("*").alias("episodes"))
