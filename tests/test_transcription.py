import pytest
from pyspark.sql import functions as F

from earshot.operators import transcription as t

FLAGS = [(1, True), (2, False), (3, None), (4, False)]


def test_backlog_leaves_unknown_out(spark):
    df = spark.createDataFrame(FLAGS, "episode_id bigint, transcribed boolean")
    assert t.backlog_count(df).first()[0] == 2
    assert t.backlog_count(df.limit(0)).first()[0] == 0


def test_work_list_is_oldest_first(spark):
    data = [(i, 1 if i != 5 else 99, f"T{i}", f"u{i}", False if i % 4 else None, f"2024-01-{20 - i:02d}") for i in range(10)]
    episodes = spark.createDataFrame(
        data, "episode_id bigint, podcast_id bigint, episode_title string, audio_url string, transcribed boolean, at string"
    ).withColumn("uploaded_at", F.col("at").cast("timestamp_ntz"))
    podcasts = spark.createDataFrame([(1, "Pod")], "podcast_id bigint, podcast_name string")
    got = t.work_list(episodes, podcasts, 3).collect()
    # 8 has no flag, 5 has no podcast.
    assert [r["episode_id"] for r in got] == [9, 7, 6] and got[0]["podcast_name"] == "Pod"


def test_guard_required(spark):
    df = spark.createDataFrame(
        [(1, "p", "t", "u"), (2, None, "t", "u"), (3, "p", "", "u"), (4, "p", "t", None)],
        "id int, podcast_name string, episode_title string, audio_url string",
    )
    assert [r["status"] for r in t.guard_required(df).orderBy("id").collect()] == ["ready", "error", "error", "error"]


@pytest.mark.parametrize(
    "duration, seconds, lengths",
    [(600_000, 120, [120.0] * 5), (240_000, 120, [120.0] * 2), (30_000, 120, [30.0]), (0, 120, []),
     (600_000, 60, [60.0] * 10), (130_500, 120, [120.0, 10.5])],
)
def test_plan_slices(spark, duration, seconds, lengths):
    df = spark.createDataFrame([(1, duration)], "episode_id bigint, duration_ms bigint")
    got = t.plan_slices(df, seconds).orderBy("slice_index").collect()
    assert [r["duration_s"] for r in got] == lengths
    assert [r["start_ms"] for r in got] == [i * seconds * 1000 for i in range(len(lengths))]


def test_plan_slices_rejects_nonsense(spark):
    with pytest.raises(ValueError):
        t.plan_slices(spark.range(1), 0)


def test_stitch_uses_the_durations_before(spark):
    slices = spark.createDataFrame(
        [(1, 0, 120.0), (1, 1, 100.0), (1, 2, 120.0), (2, 0, 5.0)], "episode_id bigint, slice_index int, duration_s double"
    )
    segments = spark.createDataFrame(
        [(1, 2, 0, "A", 1.0, 2.0, "c"), (1, 0, 0, "A", 0.0, 10.0, "a"), (1, 1, 1, "B", 3.0, 4.0, "b2"),
         (1, 1, 0, "B", 3.0, 3.5, "b1"), (2, 0, 0, "A", 0.5, 1.0, "x"), (1, 0, 1, "A", 123.0, 124.0, "a2")],
        "episode_id bigint, slice_index int, pos int, speaker string, start_time double, end_time double, text string",
    )
    got = [(r["episode_id"], r["text"], r["start_time"], r["end_time"]) for r in t.stitch_segments(slices, segments).collect()]
    # Equal starts (a2 ran over its slice) keep slice and position order.
    assert got == [
        (1, "a", 0.0, 10.0), (1, "a2", 123.0, 124.0), (1, "b1", 123.0, 123.5), (1, "b2", 123.0, 124.0),
        (1, "c", 221.0, 222.0), (2, "x", 0.5, 1.0),
    ]


def test_stitch_adds_up_what_came_before(spark):
    slices = spark.createDataFrame(
        [(1, 0, 120.0), (1, 1, 120.0), (1, 2, 37.213)], "episode_id bigint, slice_index int, duration_s double"
    )
    segments = spark.createDataFrame(
        [(1, i, 0, "A", 0.0, 1.0, "x") for i in range(3)],
        "episode_id bigint, slice_index int, pos int, speaker string, start_time double, end_time double, text string",
    )
    assert [r["start_time"] for r in t.stitch_segments(slices, segments).collect()] == [0.0, 120.0, 240.0]


def test_assemble_text_fails_with_any_slice(spark, rows):
    df = spark.createDataFrame(
        [(1, 1, True, " two "), (1, 0, True, "one"), (2, 0, True, "x"), (2, 1, False, None), (3, 0, None, "y")],
        "episode_id bigint, slice_index int, ok boolean, text string",
    )
    assert rows(t.assemble_text(df)) == [(1, "success", "one  two"), (2, "failed", None), (3, "failed", None)]


def test_apply_transcribed(spark, rows):
    df = spark.createDataFrame(FLAGS, "episode_id bigint, transcribed boolean")
    done = spark.createDataFrame([(2,), (2,), (3,), (99,)], "episode_id bigint")
    assert rows(t.apply_transcribed(df, done)) == [(1, True), (2, True), (3, True), (4, False)]


def test_one_failed_result_does_not_stop_the_others(spark, rows):
    df = spark.createDataFrame(
        [(1, "success"), (2, "no_work"), (3, "error"), (4, "failed"), (5, None), (6, "success")],
        "episode_id bigint, status string",
    )
    routed = t.route_outcomes(df)
    assert dict(rows(routed, "episode_id", "route")) == {
        1: "process", 2: "skipped", 3: "skipped", 4: "failed", 5: "failed", 6: "process"
    }
    assert dict(rows(t.outcome_counts(routed))) == {"process": 2, "skipped": 2, "failed": 2}
    # Nothing to do gives no rows rather than a surplus worker.
    assert t.outcome_counts(t.route_outcomes(df.limit(0))).count() == 0
