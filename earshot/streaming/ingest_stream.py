"""Continuous ingestion: the same rules as the batch load, whatever files a micro-batch takes.

A micro-batch may hold a part of a poll, or many polls. Per podcast, Spark keeps as state which
polls loaded something and the first entries of its opening poll; with that every
entry is judged when it arrives, and what may be loaded is appended to the
target as *claims*: entries newer than the polls before theirs, and for podcasts
without such a poll all entries of theirs. Reading the target settles the claims: the
first entries of an opening poll, and of equal urls the earliest. So the result
does not depend on how the files of a poll are cut into batches. Polls themselves
are taken in the order in which they land; one of whose entries other podcasts own all urls
counts as loaded.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from earshot.functions.grouping import first_per_group, top_n
from earshot.functions.keys import hash_id, require_distinct_ids
from earshot.operators.ingest import FEED_SUFFIXES, audio_url, checked_episodes, landed_entries
from earshot.schemas import FEED_DOCUMENT, FEED_ENTRY, TABLES
from earshot.session import tune

_EPISODE = TABLES["episode"].fieldNames()
CLAIMS = ", ".join(
    [f"{n} {TABLES['episode'][n].dataType.simpleString()}" for n in _EPISODE]
    + ["feed_pos bigint", "first_n int", "valid boolean"]
)
# What a podcast's entries are judged by; times are microseconds, and no time is one before all others.
_JUDGED = (
    "podcast_id bigint, fetched bigint, feed_pos bigint, audio_url string, dated bigint, valid boolean, "
    "published bigint, episode_title string"
)
_STATE = "loaded array<bigint>, polls array<bigint>, places array<bigint>, urls array<string>, valid array<boolean>"
_CLAIM = Row(*[piece.split()[0] for piece in _JUDGED.split(", ")], "first_n")
_NEVER = -(1 << 62)
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _by_place(entry: tuple[tuple[int | None, str], bool]) -> tuple:
    (place, url), valid = entry
    return place is not None, place or 0, url, valid


class Polls(StatefulProcessor):
    """Judges a podcast's entries by what its polls before loaded."""

    def __init__(self, first_n: int):
        self.first_n = first_n

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("polls", _STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        held = self.state.get() or ((), (), (), (), ())
        loaded = set(held[0] or ())
        opening: dict[int, dict[tuple[int, str], bool]] = {}
        for poll, place, url, valid in zip(*[part or () for part in held[1:]]):
            opening.setdefault(poll, {})[place, url] = valid
        polls: dict[int, list[Row]] = {}
        for row in rows:
            polls.setdefault(row["fetched"], []).append(row)
        for poll, entries in sorted(polls.items()):
            before = [t for t in loaded if t < poll]
            before += [t for t, first in opening.items() if t < poll and any(first.values())]
            if before:
                newest = max(before)
                entries = [e for e in entries if e["valid"] and e["dated"] > newest]
                if entries:
                    loaded.add(poll)
            else:
                seen = opening.setdefault(poll, {})
                seen.update(((e["feed_pos"], e["audio_url"] or ""), e["valid"]) for e in entries)
                opening[poll] = dict(sorted(seen.items(), key=_by_place)[: self.first_n])
            for entry in entries:
                yield _CLAIM(*entry, 0 if before else self.first_n)
        flat = [(poll, place, url, valid) for poll, first in opening.items() for (place, url), valid in first.items()]
        self.state.update((sorted(loaded), *[list(part) for part in (zip(*flat) if flat else ([], [], [], []))]))

    def close(self) -> None:
        pass


def _micros(time: Column) -> Column:
    return F.coalesce(F.unix_micros(time.cast("timestamp")), F.lit(_NEVER))


def _time(micros: str) -> Column:
    return F.when(F.col(micros) != _NEVER, F.timestamp_micros(micros).cast("timestamp_ntz"))


def claims_of(entries: DataFrame, podcasts: DataFrame, first_n: int) -> DataFrame:
    """What the entries of a stream claim."""
    first, second = FEED_SUFFIXES
    url = F.col("podcast_url")
    gated = entries.filter(F.coalesce(url.endswith(first) | url.endswith(second), F.lit(False))).join(
        podcasts.select("podcast_id").distinct(), "podcast_id", "left_semi"
    )
    judged = checked_episodes(gated).select(
        "podcast_id",
        _micros(F.col("fetched_at")).alias("fetched"),
        "feed_pos",
        "audio_url",
        _micros(F.coalesce("published_parsed", "published_at")).alias("dated"),
        F.col("reject_reason").isNull().alias("valid"),
        _micros(F.col("published_at")).alias("published"),
        "episode_title",
    )
    claimed = judged.groupBy("podcast_id").transformWithState(
        Polls(first_n), f"{_JUDGED}, first_n int", "append", "none"
    )
    return claimed.select(
        hash_id(F.col("audio_url")).alias("episode_id"),
        "podcast_id",
        _time("fetched").alias("uploaded_at"),
        "audio_url",
        F.lit(False).alias("transcribed"),
        _time("published").alias("published_at"),
        "episode_title",
        "feed_pos",
        F.when(F.col("first_n") > 0, F.col("first_n")).alias("first_n"),
        "valid",
    )


def settle(claims: DataFrame) -> DataFrame:
    """Episodes that come out of the claims."""
    once = claims.dropDuplicates(["podcast_id", "uploaded_at", "feed_pos", "audio_url"])
    opening = once.filter("first_n IS NOT NULL")
    most = opening.agg(F.max("first_n")).head()[0] or 1
    taken = top_n(
        opening, ["podcast_id", "uploaded_at"], [F.col("feed_pos"), F.coalesce("audio_url", F.lit(""))], most,
        salt_by=["feed_pos"], rank="_position",
    ).filter("_position <= first_n")
    valid = once.filter("first_n IS NULL").unionByName(taken.drop("_position")).filter("valid")
    carry = [c for c in _EPISODE if c != "audio_url"]
    return first_per_group(valid, ["audio_url"], ["uploaded_at", "podcast_id", "feed_pos"], carry)


def read_target(spark: SparkSession, target: str) -> DataFrame:
    """Episodes loaded so far; fails if an id stands for two urls."""
    try:
        claims = spark.read.schema(CLAIMS).parquet(target)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        claims = spark.createDataFrame([], CLAIMS)
    return require_distinct_ids(settle(claims).select(*_EPISODE), "episode_id", F.col("audio_url"))


def ingest_stream(
    spark: SparkSession,
    landing: str,
    target: str,
    checkpoint: str,
    podcasts: DataFrame,
    first_n: int = 20,
    files_per_batch: int = 1000,
    drop_repeats_within: str | None = None,
    documents: bool = False,
) -> StreamingQuery:
    """Start loading the files below ``landing`` and stop when all are in.

    The files hold feed entries, or whole feed documents with ``documents``.
    ``read_target`` keeps urls unique. ``drop_repeats_within`` also drops repeated
    polls early, at the price of losing entries that land later than this behind
    the newest one; it is off unless asked for. A micro-batch is written once
    whatever fails: the target's log and the state belong to the same checkpoint.
    """
    tune(spark).conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    schema = FEED_DOCUMENT if documents else FEED_ENTRY
    entries = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(landing)
    if documents:
        entries = landed_entries(entries, podcasts)
    if drop_repeats_within is not None:
        entries = (
            entries.withColumn("_entry", F.coalesce(audio_url(), F.col("title"), F.lit("")))
            .withColumn("_seen", F.col("fetched_at").cast("timestamp"))
            .withWatermark("_seen", drop_repeats_within)
            .dropDuplicatesWithinWatermark(["podcast_id", "_entry", "published"])
            .drop("_entry", "_seen")
        )
    return (
        claims_of(entries, podcasts, first_n)
        .writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
