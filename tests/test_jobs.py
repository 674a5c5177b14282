"""The recurring jobs one after the other, as a user runs them."""

from datetime import datetime

from pyspark.sql import functions as F

from earshot.operators.embedding import hashing_embedder
from earshot.plans import jobs
from earshot.sources import lake
from earshot.sources.tables import read_snapshot


def rss(url, title="Pod", items=()):
    body = "".join(
        f'<item><title>{t}</title><pubDate>{d}</pubDate><enclosure url="{u}" type="audio/mpeg"/></item>' for t, u, d in items
    )
    return (
        f'<rss xmlns:atom="a"><channel><title>{title}</title><language>EN-us</language>'
        "<pubDate>Mon, 01 Jan 2024 12:00:00 +0000</pubDate>"
        f'<atom:link rel="self" type="application/rss+xml" href="{url}"/>{body}</channel></rss>'
    )


def at(*day):
    return F.lit(datetime(*day))


def test_from_feed_to_tables(spark, folder, rows):
    root, lake_root = f"{folder}/tables", f"{folder}/lake"
    one, two = "https://e.com/1.rss", "https://e.com/2.xml"
    items = [(f"Ep {i}", f"https://e.com/{i}.mp3", f"Mon, {i:02d} Jan 2024 12:00:00 +0000") for i in (3, 2, 1)]
    land = lambda *docs: spark.createDataFrame(list(docs), "url string, body string")
    status = jobs.add_podcasts(
        spark, root,
        land((one, rss(one)), (two, rss(two, " ")), ("https://e.com/3.json", rss(one)), ("https://e.com/again.rss", rss(one))),
        at(2024, 1, 1),
    )
    assert sorted(r["status"] for r in status.collect()) == ["added", "duplicate", "not a feed url", "title"]
    assert rows(read_snapshot(spark, root, "language"), "language_name") == [("en-us",)]

    feed = land((one, rss(one, items=items)), ("https://e.com/unknown.rss", rss(one, items=items)))
    stats = jobs.load_new_episodes(spark, root, feed, at(2024, 1, 4))
    assert [tuple(r)[2:] for r in stats.filter("podcast_id is null").collect()] == [(1, 3, 3, 0)]
    assert jobs.load_new_episodes(spark, root, feed, at(2024, 1, 5)).filter("podcast_id is not null").count() == 0
    late = [*items, ("Ep 9", "https://e.com/9.mp3", "Tue, 09 Jan 2024 12:00:00 +0000")]
    stats = jobs.load_new_episodes(spark, root, land((one, rss(one, items=late))), at(2024, 1, 10))
    assert [tuple(r)[2:] for r in stats.filter("podcast_id is null").collect()] == [(1, 1, 1, 0)]
    episodes = {r["episode_title"]: r["episode_id"] for r in read_snapshot(spark, root, "episode").collect()}
    assert len(episodes) == 4

    a, b, gone = episodes["Ep 1"], episodes["Ep 2"], 12345
    slices = spark.createDataFrame(
        [(a, 0, 120.0, True, "hello " * 60), (a, 1, 30.0, True, "world"), (b, 0, 60.0, False, None)],
        "episode_id bigint, slice_index int, duration_s double, ok boolean, text string",
    )
    segments = spark.createDataFrame(
        [(a, 1, 0, "A", 1.0, 2.0, "world"), (a, 0, 0, "B", 0.0, 9.0, "hello")],
        "episode_id bigint, slice_index int, pos int, speaker string, start_time double, end_time double, text string",
    )
    routed = jobs.store_transcripts(spark, root, slices, segments, lake_root)
    assert dict(rows(routed, "episode_id", "route")) == {a: "process", b: "failed"}
    flags = dict(rows(jobs.read_episodes(spark, root), "episode_id", "transcribed"))
    assert flags[a] is True and flags[b] is False
    # A repeated run replaces what it stored; one with another episode leaves the rest alone.
    jobs.store_transcripts(spark, root, slices, segments, lake_root)
    other = slices.filter(F.col("episode_id") == b).withColumns({"ok": F.lit(True), "text": F.lit("now it worked")})
    jobs.store_transcripts(spark, root, other, segments.limit(0), lake_root)
    assert rows(lake.read_partitioned(spark, f"{lake_root}/segments"), "start_time", "text") == [(0.0, "hello"), (121.0, "world")]
    assert rows(lake.read_partitioned(spark, f"{lake_root}/transcripts"), "episode_id") == sorted([(str(a),), (str(b),)], key=repr)

    again = slices.filter(F.col("episode_id") == b).withColumns({"ok": F.lit(True), "text": F.lit("transcribed anew")})
    jobs.store_transcripts(spark, root, again, segments.limit(0), lake_root)
    texts = dict(rows(lake.read_partitioned(spark, f"{lake_root}/transcripts"), "episode_id", "transcript_text"))
    assert texts[str(b)] == "transcribed anew" and texts[str(a)].split()[-2:] == ["hello", "world"]
    assert rows(jobs.read_episodes(spark, root).filter("transcribed"), "episode_id") == sorted([(a,), (b,)], key=repr)

    responses = spark.createDataFrame(
        [(a, '{"topics": ["AI"], "summary": "S", "speakers": [{"name": "Ann"}]}'), (b, "oops"), (gone, '{"topics": []}')],
        "episode_id bigint, response string",
    )
    report = jobs.store_analyses(spark, root, responses, lake_root)
    assert dict(rows(report)) == {a: "stored", b: "failed", gone: "episode missing"}
    assert rows(read_snapshot(spark, root, "topics"), "topic_name") == [("AI",)]
    assert rows(lake.read_summaries(spark, f"{lake_root}/summaries"), "summary", "speakers") == [("S", ["Ann"])]

    texts = lake.read_partitioned(spark, f"{lake_root}/transcripts").select("episode_id", "transcript_text")
    extra = spark.createDataFrame([(str(gone), "x " * 200)], texts.schema)
    report = jobs.store_embeddings(spark, root, texts.unionByName(extra), hashing_embedder(64), dim=64, size=20, overlap=10)
    assert dict(rows(report)) == {a: "stored", gone: "episode missing", b: "too short"}
    stored = jobs.read_embeddings(spark, root)
    assert stored.count() == 7 and stored.select("episode_id").distinct().count() == 1
    jobs.store_embeddings(spark, root, texts, hashing_embedder(64), dim=64, size=61, overlap=0)
    assert jobs.read_embeddings(spark, root).count() == 1


def test_versions_of_a_feed_are_all_loaded(spark, folder, rows):
    """An earlier and a later fetch and a further page of one feed land in one call."""
    one = "https://e.com/1.rss"
    item = lambda i, title=None: (title or f"Ep {i}", f"https://e.com/{i}.mp3", f"Mon, {i:02d} Jan 2024 12:00:00 +0000")
    land = lambda *bodies: spark.createDataFrame([(one, b) for b in bodies], "url string, body string")
    for number, order in enumerate((1, -1)):
        root = f"{folder}/tables{number}"
        jobs.add_podcasts(spark, root, land(rss(one)), at(2024, 1, 1))
        # A repeat inside a document is a skipped entry, once; one version lacks a title.
        bodies = [
            rss(one, items=[item(i) for i in (3, 2, 2, 1)]),
            rss(one, items=[item(4), item(3), item(2, " "), item(2)]),
            rss(one, "Pod, page 2", items=[item(6), item(5)]),
        ][::order]
        stats = jobs.load_new_episodes(spark, root, land(*bodies, bodies[0]), at(2024, 1, 7), first_n=7)
        assert [tuple(r)[2:] for r in stats.filter("podcast_id is null").collect()] == [(1, 7, 6, 1)]
        stored = read_snapshot(spark, root, "episode")
        assert rows(stored, "episode_title") == [(f"Ep {i}",) for i in range(1, 7)]
        # Later versions: an entry dated before the cutoff in one of them, after it in the other.
        late = ("Ep 8", "https://e.com/8.mp3", "Sat, 06 Jan 2024 12:00:00 +0000")
        again = land(rss(one, items=[late, item(9)]), rss(one, items=[item(3), item(10), item(8)]))
        stats = jobs.load_new_episodes(spark, root, again, at(2024, 1, 11))
        assert [tuple(r)[2:] for r in stats.filter("podcast_id is null").collect()] == [(1, 3, 3, 0)]
        assert read_snapshot(spark, root, "episode").count() == 9
