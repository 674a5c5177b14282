"""Schemas of the relational tables and of the lake datasets."""

from __future__ import annotations

from pyspark.sql import types as T

LONG, STRING, NTZ = T.LongType(), T.StringType(), T.TimestampNTZType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


LINK = _struct(rel=STRING, type=STRING, href=STRING)

TABLES: dict[str, T.StructType] = {
    "language": _struct(language_id=LONG, language_name=STRING),
    "speakers": _struct(speaker_id=LONG, speaker_name=STRING, speaker_username=STRING),
    "topics": _struct(topic_id=LONG, topic_name=STRING),
    "podcast": _struct(
        podcast_id=LONG,
        podcast_name=STRING,
        publish_date=NTZ,
        language_id=LONG,
        uploaded_at=NTZ,
        podcast_url=STRING,
    ),
    "episode": _struct(
        episode_id=LONG,
        podcast_id=LONG,
        uploaded_at=NTZ,
        audio_url=STRING,
        transcribed=T.BooleanType(),
        published_at=NTZ,
        episode_title=STRING,
    ),
    "episode_speakers": _struct(speaker_id=LONG, episode_id=LONG),
    "episode_topics": _struct(episode_id=LONG, topic_id=LONG),
    "episode_embedding": _struct(
        episode_id=LONG,
        chunk_index=LONG,
        chunk_text=STRING,
        transcript_embedding=T.ArrayType(T.FloatType()),
    ),
}

# Records inside the files; podcast_id and episode_id live in the folder names
# and stay strings there.
TRANSCRIPT_RECORD = _struct(transcript_text=STRING)
SEGMENT_RECORD = _struct(
    start_time=T.DoubleType(), end_time=T.DoubleType(), speaker=STRING, text=STRING
)
SUMMARY_RECORD = _struct(
    summary=STRING, topics=T.ArrayType(STRING), speakers=T.ArrayType(STRING)
)
PARTITION_KEYS = _struct(podcast_id=STRING, episode_id=STRING)

FEED_DOCUMENT = _struct(url=STRING, body=STRING, fetched_at=NTZ)
FEED_ENTRY = _struct(
    podcast_id=LONG,
    podcast_name=STRING,
    podcast_url=STRING,
    feed_pos=LONG,
    title=STRING,
    links=T.ArrayType(LINK),
    link=STRING,
    href=STRING,
    published_parsed=NTZ,
    published=STRING,
    fetched_at=NTZ,
)
