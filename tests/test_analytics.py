from datetime import datetime

import pytest
from pyspark.sql import functions as F

from earshot.operators import analytics as a


@pytest.fixture(scope="module")
def d(spark):
    frame = lambda data, schema: spark.createDataFrame(data, schema)
    at = lambda day: datetime(2024, 3, day)
    return {
        # Two podcasts share a name, one has no episodes.
        "podcasts": frame(
            [(1, "Pod", "u1"), (2, "Pod", "u2"), (3, "Solo", "u3"), (4, "Empty", "u4")],
            "podcast_id bigint, podcast_name string, podcast_url string",
        ).withColumn("uploaded_at", F.lit(at(1)).cast("timestamp_ntz")),
        "episodes": frame(
            [(10, 1, "a", at(3), True, at(4)), (11, 1, "b", at(3), False, at(5)), (20, 2, "c", None, None, at(6)),
             (30, 3, "d", at(9), True, at(10))],
            "episode_id bigint, podcast_id bigint, episode_title string, published_at timestamp_ntz, "
            "transcribed boolean, uploaded_at timestamp_ntz",
        ),
        "topics": frame([(1, "AI-powered"), (2, "ai-Powered"), (3, "health")], "topic_id bigint, topic_name string"),
        "episode_topics": frame([(10, 1), (10, 2), (11, 2), (20, 3), (30, 3)], "episode_id bigint, topic_id bigint"),
        "speakers": frame([(1, "Ann"), (2, "Bob")], "speaker_id bigint, speaker_name string"),
        "episode_speakers": frame([(10, 1), (10, 2), (20, 1)], "episode_id bigint, speaker_id bigint"),
    }


def args(d, *names):
    return [d[n] for n in names]


def test_joined_columns_are_told_apart(d):
    got = a.episodes_with_podcast(d["episodes"], d["podcasts"])
    assert len(set(got.columns)) == len(got.columns) and "podcast_uploaded_at" in got.columns
    assert got.count() == 4


def test_counts(d, rows):
    e, p = d["episodes"], d["podcasts"]
    assert rows(a.content_counts(e, p)) == [(4, 4, 2)]
    assert rows(a.content_counts(e, p, by="podcast_name")) == [("Empty", 1, 0, 0), ("Pod", 2, 3, 1), ("Solo", 1, 1, 1)]
    assert rows(a.episodes_per_podcast(e, p)) == [("Empty", 0), ("Pod", 3), ("Solo", 1)]
    with pytest.raises(ValueError):
        a.content_counts(e, p, by="podcast_url")


def test_topics(d):
    parts = args(d, "episodes", "podcasts", "topics", "episode_topics")
    got = [tuple(r) for r in a.topics_per_podcast(*parts).collect()]
    assert got == [("Pod", "Ai-Powered", 2), ("Pod", "Health", 1), ("Solo", "Health", 1)]
    top = [tuple(r) for r in a.top_topics(*parts, n=1).collect()]
    assert top == [("Pod", "Ai-Powered", 2, 1), ("Solo", "Health", 1, 1)]
    assert a.topic_frequency(*parts).count() == 3 and a.topic_frequency(*parts, n=1).count() == 2


def test_speakers(d):
    parts = args(d, "episodes", "podcasts", "speakers", "episode_speakers")
    assert [tuple(r) for r in a.speaker_frequency(*parts).collect()] == [("Pod", "Ann", 2), ("Pod", "Bob", 1)]
    assert [tuple(r) for r in a.speaker_frequency(*parts, n=1).collect()] == [("Pod", "Ann", 2, 1)]


def test_timeline_and_running_count(d):
    e, p = d["episodes"], d["podcasts"]
    assert [r["episode_id"] for r in a.published_timeline(e, p).collect()] == [10, 11, 30]
    as_of = lambda *day: F.lit(datetime(*day)).cast("timestamp_ntz")
    got = a.cumulative_published(e, p, as_of(2024, 4, 3)).collect()
    assert [(r["podcast_name"], r["episode_id"], r["cumulative_episodes"]) for r in got] == [
        ("Pod", 10, 1), ("Pod", 11, 2), ("Solo", 30, 1)
    ]
    assert a.cumulative_published(e, p, as_of(2024, 4, 4)).count() == 1
    # One month before the 31st is the last day of a shorter month.
    leap = e.withColumn("published_at", F.lit(datetime(2024, 2, 29)).cast("timestamp_ntz"))
    assert a.cumulative_published(leap, p, as_of(2024, 3, 31)).count() == 4


def test_per_episode_counts(d):
    got = a.topics_per_episode(*args(d, "episodes", "podcasts", "episode_topics")).collect()
    # Undated episodes come first.
    assert [(r["episode_id"], r["topic_count"]) for r in got] == [(20, 1), (10, 2), (11, 1), (30, 1)]
    details = a.episode_details(*args(d, "episodes", "podcasts", "episode_topics", "episode_speakers")).collect()
    assert [(r["episode_id"], r["topic_count"], r["speaker_count"]) for r in details] == [
        (20, 1, 1), (10, 2, 2), (11, 1, 0), (30, 1, 0)
    ]


def test_podcast_stats(d, rows):
    got = a.podcast_stats(*args(d, "episodes", "podcasts", "episode_topics", "episode_speakers"))
    assert rows(got) == [("Empty", 0, 0, 0, None, None), ("Pod", 3, 1, 1, 4 / 3, 1.0), ("Solo", 1, 1, 0, 1.0, 0.0)]


def test_words(spark, d, rows):
    texts = spark.createDataFrame(
        [("1", "10", "one two"), ("1", "30", ""), ("1", "11", "a  b"), ("1", "99", "x"), ("2", "20", None)],
        "podcast_id string, episode_id string, transcript_text string",
    )
    assert rows(a.word_counts(texts), "episode_id", "word_count") == [
        ("10", 2), ("11", 3), ("20", None), ("30", 1), ("99", 1)
    ]
    series = a.transcript_length_series(d["episodes"], texts).collect()
    assert [(r["episode_id"], r["word_count"]) for r in series] == [(10, 2), (11, 3), (30, 1)]
    assert rows(a.word_count_summary(texts)) == [("1", 4, 1, 3, 2), ("2", 0, None, None, None)]


def test_shuffles_are_cut_by_size(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        parts = spark.range(12_000_000).selectExpr("xxhash64(id) AS key").repartition("key").rdd.getNumPartitions()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert parts > 4


def test_repeated_rows_count_once(spark, rows):
    episodes = spark.createDataFrame([(1, 7), (1, 7), (2, 7), (3, 8), (None, 8)], "episode_id bigint, podcast_id bigint")
    podcasts = spark.createDataFrame([(7, "A"), (8, "A")], "podcast_id bigint, podcast_name string")
    speakers = spark.createDataFrame([(1, "Ann"), (2, "Ann"), (3, None)], "speaker_id bigint, speaker_name string")
    said = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (2, 2), (3, 1), (3, 3), (None, 1)], "episode_id bigint, speaker_id bigint")
    got = a.speaker_frequency(episodes, podcasts, speakers, said)
    assert rows(got, "podcast_name", "speaker_name", "episode_count") == [("A", "Ann", 3), ("A", None, 1)]
