import tempfile
from datetime import datetime

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from earshot.schemas import FEED_DOCUMENT, FEED_ENTRY
from earshot.streaming import ingest_stream as ingest_stream_module
from earshot.streaming.ingest_stream import ingest_stream, read_target

POLLS = {1: datetime(2024, 2, 1), 2: datetime(2024, 2, 2), 3: datetime(2024, 2, 3)}


def entry(podcast, pos, url, day, poll):
    return (podcast, f"P{podcast}", f"https://e.com/{podcast}.rss", pos, f"T{pos}", [("enclosure", None, url)], None, None,
            day, None, POLLS[poll])


def frame(spark, *given):
    return spark.createDataFrame(list(given), FEED_ENTRY)


def podcasts(spark):
    return spark.createDataFrame([(1,), (2,)], "podcast_id bigint")


def run(spark, folder, **options):
    ingest_stream(
        spark, f"{folder}/landing", f"{folder}/episodes", f"{folder}/progress", podcasts(spark), **options
    ).awaitTermination()
    return read_target(spark, f"{folder}/episodes")


def land(spark, folder, *given):
    frame(spark, *given).coalesce(1).write.mode("append").parquet(f"{folder}/landing")


JAN, FEB2 = datetime(2024, 1, 1), datetime(2024, 2, 1, 12)


def test_polls_over_several_runs(spark, folder, rows):
    first = [entry(1, i, f"https://e.com/{i}.mp3", JAN, 1) for i in range(25)]
    land(spark, folder, *first, entry(9, 0, "https://e.com/x.mp3", JAN, 1))
    got = run(spark, folder)
    # First twenty of a new podcast; the unknown podcast brings nothing.
    assert got.count() == 20
    assert run(spark, folder).count() == 20
    again = [entry(1, i, f"https://e.com/{i}.mp3", JAN, 2) for i in range(25)]
    land(spark, folder, *again, entry(1, 25, "https://e.com/new.mp3", FEB2, 2), entry(2, 0, "https://e.com/new.mp3", FEB2, 2))
    got = run(spark, folder)
    assert got.count() == 21
    assert rows(got.filter("audio_url like '%new%'"), "podcast_id", "uploaded_at") == [(1, POLLS[2])]


def test_two_polls_in_one_batch(spark, folder, rows):
    land(
        spark, folder,
        *[entry(1, i, f"https://e.com/{i}.mp3", JAN, 1) for i in range(3)],
        *[entry(1, i, f"https://e.com/{i}.mp3", JAN, 2) for i in range(3)],
        entry(1, 3, "https://e.com/later.mp3", FEB2, 2),
    )
    got = run(spark, folder, first_n=2)
    assert rows(got, "audio_url", "uploaded_at") == [
        ("https://e.com/0.mp3", POLLS[1]), ("https://e.com/1.mp3", POLLS[1]), ("https://e.com/later.mp3", POLLS[2])
    ]


def test_files_that_land_again_store_nothing_twice(spark, folder, rows):
    given = [entry(1, 0, "https://e.com/a.mp3", JAN, 1), entry(1, 1, "https://e.com/b.mp3", JAN, 1)]
    for _ in range(3):
        land(spark, folder, *given)
        got = run(spark, folder)
        assert rows(got, "audio_url") == [("https://e.com/a.mp3",), ("https://e.com/b.mp3",)]
    # A run that lost its progress takes all files again and starts from no state.
    ingest_stream(spark, f"{folder}/landing", f"{folder}/other", f"{folder}/fresh", podcasts(spark)).awaitTermination()
    assert rows(read_target(spark, f"{folder}/other")) == rows(got)


def test_polls_without_a_usable_entry_leave_a_podcast_open(spark, folder, rows):
    nothing = ("P1", "https://e.com/1.rss")
    bad = [(1, *nothing, i, " ", [], None, None, JAN, None, POLLS[1]) for i in range(3)]
    land(spark, folder, *bad)
    assert run(spark, folder, first_n=2).count() == 0
    # The second poll is the opening one; a late part of the first changes nothing, the third is held against the second.
    land(spark, folder, *[entry(1, i, f"https://e.com/{i}.mp3", JAN, 2) for i in range(3)])
    assert run(spark, folder, first_n=2).count() == 2
    land(spark, folder, *[entry(1, i, f"https://e.com/{i}.mp3", JAN, 3) for i in range(5)], entry(1, 9, "https://e.com/9.mp3", POLLS[3], 3))
    assert rows(run(spark, folder, first_n=2), "audio_url") == [(f"https://e.com/{i}.mp3",) for i in (0, 1, 9)]


def test_repeats_may_be_dropped_early(spark, folder):
    same = entry(1, 0, "https://e.com/a.mp3", JAN, 1)
    land(spark, folder, same, same, entry(1, 1, "https://e.com/b.mp3", JAN, 1))
    assert run(spark, folder, drop_repeats_within="7 days").count() == 2


def test_files_may_be_cut_into_batches_anyhow(spark, rows):
    """One opening poll and one later poll over eight files each."""
    opening = [entry(p, i, f"https://e.com/{p}-{i % 40}.mp3", JAN, 1) for p in (1, 2) for i in range(60)]
    later = [entry(p, i, f"https://e.com/late-{i}.mp3", FEB2, 2) for p in (1, 2) for i in range(30)]
    results = []
    for files in (1, 2, 3, 1000):
        folder = tempfile.mkdtemp(prefix="earshot-test-")
        for poll in (opening, later):
            frame(spark, *poll).repartition(8, "feed_pos").write.mode("append").parquet(f"{folder}/landing")
            got = run(spark, folder, files_per_batch=files)
        results.append(rows(got, "podcast_id", "audio_url", "uploaded_at"))
    assert len(results[0]) == 20 + 20 + 30 and all(r == results[0] for r in results)


def test_ids_of_the_stream_are_checked(spark, folder, monkeypatch):
    monkeypatch.setattr(ingest_stream_module, "hash_id", lambda col: F.when(col.isNotNull(), F.lit(5)).cast("long"))
    land(spark, folder, entry(1, 0, "https://e.com/a.mp3", JAN, 1), entry(1, 1, "https://e.com/b.mp3", JAN, 1))
    with pytest.raises(ValueError, match="stands for two keys"):
        run(spark, folder)


def test_documents_land_as_they_are(spark, folder, rows):
    item = "<item><title>T{0}</title><pubDate>Mon, 01 Jan 2024 12:00:00 +0000</pubDate><enclosure url='https://e.com/{0}.mp3'/></item>"
    body = "<rss><channel>" + "".join(item.format(i) for i in range(4)) + "</channel></rss>"
    known = spark.createDataFrame([(1, "P1", "https://e.com/1.rss")], "podcast_id bigint, podcast_name string, podcast_url string")
    documents = spark.createDataFrame(
        [("https://e.com/1.rss", body, POLLS[1]), ("https://e.com/unknown.rss", body, POLLS[1])], FEED_DOCUMENT
    )
    documents.write.parquet(f"{folder}/landing")
    for _ in range(2):
        ingest_stream(
            spark, f"{folder}/landing", f"{folder}/episodes", f"{folder}/progress", known, first_n=3, documents=True
        ).awaitTermination()
    assert rows(read_target(spark, f"{folder}/episodes"), "audio_url") == [(f"https://e.com/{i}.mp3",) for i in range(3)]


def test_polls_are_judged_row_by_row():
    """A podcast's few entries cost no frame of their own, one per poll or otherwise."""

    class Handle:
        kept = None

        def getValueState(self, *_):
            return self

        def get(self):
            return self.kept

        def update(self, value):
            self.kept = value

    entry = Row("podcast_id", "fetched", "feed_pos", "audio_url", "dated", "valid", "published", "episode_title")
    polls = ingest_stream_module.Polls(2)
    polls.init(handle := Handle())
    judge = lambda *entries: [tuple(r) for r in polls.handleInputRows((1,), iter(entries), None)]
    first = [entry(1, 10, None, None, 5, False, 5, "x"), entry(1, 10, 3, "c", 5, True, 5, "c"), entry(1, 10, 1, "a", 5, False, 5, "a")]
    assert judge(*first) == [(*e, 2) for e in first]
    assert judge(entry(1, 20, 2, "b", 11, True, 11, "b")) == [(1, 20, 2, "b", 11, True, 11, "b", 2)]
    late = [entry(1, 30, 1, "d", 25, True, 25, "d"), entry(1, 30, 2, "e", 19, True, 19, "e"), entry(1, 30, 3, "f", 25, False, 25, "f")]
    assert judge(*late) == [(*late[0], 0)]
    assert handle.kept[0] == [30]
