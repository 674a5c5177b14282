"""Keyed access to the lake, for a whole table of keys at once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.functions.grouping import mark_existing
from earshot.functions.text import is_missing

KEYS = ["podcast_id", "episode_id"]


def transcript_coverage(episodes: DataFrame, transcripts: DataFrame) -> DataFrame:
    """Episodes with a flag telling whether a transcript is stored."""
    stored = transcripts.select(F.col("episode_id").cast("string").alias("episode_key"))
    keyed = episodes.withColumn("episode_key", F.col("episode_id").cast("string"))
    return mark_existing(keyed, stored, ["episode_key"], "has_transcript").drop("episode_key")


def _lookup(keys: DataFrame, dataset: DataFrame, value: str) -> DataFrame:
    as_text = [F.col(k).cast("string").alias(k) for k in KEYS]
    asked = keys.select(*as_text).distinct()
    others = [c for c in dataset.columns if c not in KEYS]
    stored = dataset.select(*as_text, *others, F.lit(True).alias("_stored"))
    # An always-true comparison marks the keys as a selection, so that a key table
    # small enough to broadcast also prunes the folders that are scanned.
    picked = asked.filter(F.coalesce("episode_id", F.lit("")) >= "")
    found = asked.join(stored.join(picked, KEYS), KEYS, "left")
    status = (
        F.when(F.col("_stored").isNull(), "missing").when(is_missing(F.col(value)), "empty").otherwise("found")
    )
    return found.withColumn("status", status).drop("_stored")


def lookup_transcripts(keys: DataFrame, transcripts: DataFrame) -> DataFrame:
    """Transcript per asked key with ``status`` found, missing or empty.

    Keys are compared as strings, so folder-name keys and integer ids both work.
    """
    return _lookup(keys, transcripts.select(*KEYS, "transcript_text"), "transcript_text")


def lookup_summaries(keys: DataFrame, summaries: DataFrame) -> DataFrame:
    """Summary, topics and speakers per asked key; the arrays stay arrays."""
    return _lookup(keys, summaries.select(*KEYS, "summary", "topics", "speakers"), "summary")
