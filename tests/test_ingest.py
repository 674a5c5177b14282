from datetime import datetime

import pytest
from pyspark.sql import functions as F

from earshot.operators import ingest
from earshot.schemas import FEED_ENTRY
from earshot.sources.feeds import parse_feed_entries, parse_feeds, unreadable_feeds

FEED = (
    "row_id bigint, title string, published string, language string, link string, new_feed_url string, "
    "links array<struct<rel:string,type:string,href:string>>"
)
GOOD_DATE = "Tue, 05 Jul 2022 08:30:00 +0000"
RSS = "application/rss+xml"


def feed(row_id, title="Night Trains", published=GOOD_DATE, language="pt-br", link="https://e.com/f", moved=None, links=()):
    return (row_id, title, published, language, link, moved, list(links))


def entry(pos, podcast=1, name="Pod", url="https://e.com/f.rss", title="Episode", links=None, link=None, href=None,
          parsed=datetime(2024, 1, 15, 10, 30), published=None):
    links = [("enclosure", None, f"https://e.com/{podcast}-{pos}.mp3")] if links is None else links
    return (podcast, name, url, pos, title, links, link, href, parsed, published, datetime(2024, 2, 1))


def entries(spark, *given):
    return spark.createDataFrame(list(given), FEED_ENTRY)


def cutoffs(spark, *given):
    return spark.createDataFrame(list(given), "podcast_id bigint, cutoff timestamp_ntz")


# -- feeds ---------------------------------------------------------------------


def test_parse_feeds_keeps_order_and_prefixed_tags(spark):
    items = "".join(
        f"<item><title>Ep {i} &amp; more</title><pubDate>{GOOD_DATE}</pubDate>"
        f'<enclosure url="https://e.com/{i}.mp3" type="audio/mpeg"/></item>'
        for i in (3, 1, 2)
    )
    body = (
        '<?xml version="1.0"?><rss xmlns:itunes="i" xmlns:atom="a"><channel><title> T </title>'
        '<atom:link rel="self" type="application/rss+xml" href="https://e.com/self"/>'
        f"<itunes:new-feed-url>https://e.com/new</itunes:new-feed-url>{items}</channel></rss>"
    )
    raw = spark.createDataFrame([("u", body), ("broken", "<rss><channel>")], "url string, body string")
    feeds, found = parse_feeds(raw)
    header = feeds.filter("url = 'u'").first()
    assert header["new_feed_url"] == "https://e.com/new"
    assert [tuple(x) for x in header["links"]] == [("self", RSS, "https://e.com/self")]
    got = [(r["feed_pos"], r["title"], r["links"][0]["href"]) for r in found.orderBy("feed_pos").collect()]
    assert got == [(p, f"Ep {i} & more", f"https://e.com/{i}.mp3") for p, i in enumerate((3, 1, 2))]


def test_guid_stands_in_for_the_link(spark):
    items = [
        "<link>https://e.com/l</link><guid>https://e.com/g</guid>", "<guid>https://e.com/g</guid>",
        '<guid isPermaLink="true">https://e.com/g</guid>', '<guid isPermaLink="false">https://e.com/g</guid>',
        "<title><![CDATA[A <b>bold</b> title]]></title>",
    ]
    body = "<rss><channel>" + "".join(f"<item>{i}</item>" for i in items) + "</channel></rss>"
    raw = spark.createDataFrame([("u", body), ("broken", "<rss><channel>")], "url string, body string")
    got = parse_feed_entries(raw).orderBy("feed_pos").collect()
    assert [r["link"] for r in got] == ["https://e.com/l", "https://e.com/g", "https://e.com/g", None, None]
    assert got[4]["title"] == "A <b>bold</b> title"
    assert [r["url"] for r in unreadable_feeds(raw).collect()] == ["broken"]


def test_atom_documents(spark):
    entries_ = (
        '<entry><title type="html">One &amp; only</title><link href="https://e.com/p"/>'
        '<link rel="enclosure" href="https://e.com/a.mp3"/><updated>2022-07-05T08:30:00+02:00</updated></entry>'
        "<entry><title>Two</title><published>2022-07-04</published></entry>"
    )
    body = f'<feed xml:lang="fi"><title>F</title><link rel="self" href="https://e.com/s"/>{entries_}</feed>'
    raw = spark.createDataFrame(
        [("https://e.com/1.xml", body, datetime(2024, 1, 1)), ("bad", "<feed>", datetime(2024, 1, 1))],
        "url string, body string, fetched_at timestamp_ntz",
    )
    feeds, _ = parse_feeds(raw)
    assert tuple(feeds.filter("title = 'F'").select("language", "link", "links").first()) == (
        "fi", None, [("self", None, "https://e.com/s")]
    )
    known = spark.createDataFrame([(1, "P", "https://e.com/1.xml")], "podcast_id bigint, podcast_name string, podcast_url string")
    got = ingest.landed_entries(raw, known).orderBy("feed_pos").collect()
    assert [(r["title"], r["link"], r["published_parsed"]) for r in got] == [
        ("One & only", "https://e.com/p", datetime(2022, 7, 5, 6, 30)), ("Two", None, datetime(2022, 7, 4)),
    ]
    assert ingest.validate_episodes(ingest.landed_entries(raw, known))[0].first()["audio_url"] == "https://e.com/a.mp3"
    assert [r["url"] for r in unreadable_feeds(raw).collect()] == ["bad"]


def test_gate_feed_urls(spark):
    urls = ["a.rss", "a.xml", "a.json", "", None, "a.RSS"]
    got = ingest.gate_feed_urls(spark.createDataFrame([(u,) for u in urls], "url string"))
    assert {r["url"]: r["reject_reason"] for r in got.collect()} == {
        "a.rss": None, "a.xml": None, "a.json": "not a feed url", "": "empty url", None: "empty url",
        "a.RSS": "not a feed url",
    }


def test_validate_feeds(spark):
    given = [
        feed(0), feed(1, title="\tNight Trains ", language=" PT-BR  "), feed(2, title=None), feed(3, title=""),
        feed(4, published=None), feed(5, published="2022-07-05"), feed(6, language=None), feed(7, language=" "),
        feed(8, link=None), feed(9, title="Tea & Toast %2", language="nl-BE"),
        feed(10, published="Tue, 05 Jul 2022 08:30:00 -0700"),
    ]
    accepted, rejected = ingest.validate_feeds(spark.createDataFrame(given, FEED))
    assert accepted.columns == ["row_id", "podcast_name", "publish_date", "language_name", "podcast_url"]
    good = {r["row_id"]: tuple(r)[1:] for r in accepted.collect()}
    morning = datetime(2022, 7, 5, 8, 30)
    assert good[0] == ("Night Trains", morning, "pt-br", "https://e.com/f.rss") == good[1]
    assert good[9][0] == "Tea & Toast %2" and good[9][2] == "nl-be"
    assert good[10][1] == datetime(2022, 7, 5, 15, 30)
    assert {r["row_id"]: r["reject_reason"] for r in rejected.collect()} == {
        2: "title", 3: "title", 4: "published", 5: "published", 6: "language", 7: "language", 8: "link",
    }


def test_canonical_link_order(spark):
    own = ("self", RSS, "https://e.com/self")
    given = [
        feed(0, moved="https://e.com/new", links=[own]), feed(1, links=[("alternate", RSS, "x"), own]),
        feed(2, links=[("self", "text/html", "x")]), feed(3, link="https://e.com/f.xml"),
        feed(4, link="https://e.com/f.rss"), feed(5, link=None), feed(6, links=[("self", RSS, None)]),
    ]
    got = spark.createDataFrame(given, FEED).select("row_id", ingest.canonical_link().alias("u")).collect()
    assert dict(map(tuple, got)) == {
        0: "https://e.com/new", 1: "https://e.com/self", 2: "https://e.com/f.rss", 3: "https://e.com/f.xml",
        4: "https://e.com/f.rss", 5: None, 6: None,
    }


def test_upsert_podcasts(spark, rows):
    given = [("u1", "A", "en"), ("u2", "B", "fr"), ("u1", "A again", "de"), ("old", "C", "it")] + [
        ("hot", f"copy {i}", "en") for i in range(50)
    ]
    accepted = spark.createDataFrame(
        [(i, n, datetime(2024, 1, 1), lang, u) for i, (u, n, lang) in enumerate(given)],
        "row_id bigint, podcast_name string, publish_date timestamp_ntz, language_name string, podcast_url string",
    )
    known = spark.createDataFrame(
        [(5, "Old", None, 1, None, "old")],
        "podcast_id bigint, podcast_name string, publish_date timestamp_ntz, language_id bigint, "
        "uploaded_at timestamp_ntz, podcast_url string",
    )
    languages = spark.createDataFrame([(1, "en"), (2, "English")], "language_id bigint, language_name string")
    table, all_languages, status = ingest.upsert_podcasts(accepted, known, languages, "row_id")
    assert rows(table, "podcast_url", "podcast_name") == [("hot", "copy 0"), ("old", "Old"), ("u1", "A"), ("u2", "B")]
    # Languages of duplicates are stored as well, known ones keep their id.
    assert rows(all_languages, "language_name") == [("English",), ("de",), ("en",), ("fr",), ("it",)]
    assert rows(all_languages.filter("language_name = 'en'"), "language_id") == [(1,)]
    added = {r["row_id"] for r in status.filter("status = 'added'").collect()}
    assert added == {0, 1, 4} and status.count() == len(given)
    again, _, status = ingest.upsert_podcasts(accepted, table, all_languages, "row_id")
    assert again.count() == 4 and status.filter("status = 'added'").count() == 0


# -- selection -----------------------------------------------------------------


def test_entries_after_the_cutoff_only(spark, rows):
    given = entries(
        spark, *[entry(i, parsed=datetime(2024, 1, d, 10)) for i, d in enumerate((20, 15, 12, 10))],
        entry(9, parsed=None), entry(10, parsed=None, published="no date"),
        entry(11, parsed=None, published="Sat, 20 Jan 2024 10:00:00 +0000"),
        entry(12, parsed=None, published="Fri, 12 Jan 2024 14:00:00 +0500"),
    )
    since = cutoffs(spark, (1, datetime(2024, 1, 12, 10)))
    # The cutoff itself is not newer, and an offset is taken into account.
    assert rows(ingest.select_new_episodes(given, since), "feed_pos") == [(0,), (1,), (11,)]
    late = cutoffs(spark, (1, datetime(2025, 1, 1)))
    assert ingest.select_new_episodes(given, late).count() == 0


def test_first_entries_of_a_new_podcast(spark, rows):
    given = entries(spark, *[entry(i, parsed=None, published=f"day {i}") for i in range(30)])
    got = ingest.select_new_episodes(given, cutoffs(spark))
    assert sorted(r["feed_pos"] for r in got.collect()) == list(range(20))
    empty = cutoffs(spark, (1, None))
    assert ingest.select_new_episodes(given, empty, 3).count() == 3


def test_podcasts_without_feed_url_give_nothing(spark):
    given = entries(spark, entry(0, url="https://e.com/f.json"), entry(1, url=""), entry(2, url=None))
    assert ingest.select_new_episodes(given, cutoffs(spark)).count() == 0


def test_cutoff_by_date_finds_late_entries(spark, rows):
    episodes = spark.createDataFrame(
        [(1, datetime(2024, 1, 10), datetime(2024, 1, 5)), (1, datetime(2024, 1, 9), datetime(2024, 1, 8)), (2, None, None)],
        "podcast_id bigint, uploaded_at timestamp_ntz, published_at timestamp_ntz",
    )
    assert rows(ingest.ingest_cutoffs(episodes)) == [(1, datetime(2024, 1, 10)), (2, None)]
    assert rows(ingest.ingest_cutoffs(episodes, "published_at", "2 days")) == [(1, datetime(2024, 1, 6)), (2, None)]
    # Published before the last load, in the feed only after it.
    given = entries(spark, entry(0, parsed=datetime(2024, 1, 9)))
    assert ingest.select_new_episodes(given, ingest.ingest_cutoffs(episodes)).count() == 0
    by_date = ingest.ingest_cutoffs(episodes, "published_at")
    assert ingest.select_new_episodes(given, by_date).count() == 1
    with pytest.raises(ValueError):
        ingest.ingest_cutoffs(episodes, "episode_id")


# -- validation ----------------------------------------------------------------


@pytest.mark.parametrize(
    "links, link, href, expected",
    [
        ([("alternate", None, "https://e.com/page"), ("enclosure", None, "https://e.com/a.mp3")], None, None, "https://e.com/a.mp3"),
        ([(None, None, "https://e.com/a.mp3"), (None, None, "https://e.com/b.mp3")], None, None, "https://e.com/a.mp3"),
        ([("enclosure", None, None), ("alternate", None, "http://e.com/p")], None, None, "http://e.com/p"),
        ([("enclosure", None, "")], "https://e.com/l", None, "https://e.com/l"),
        ([("enclosure", None, "ftp://e.com/a")], " https://e.com/l\n", "https://e.com/h", "https://e.com/l"),
        ([], "", "https://e.com/h", "https://e.com/h"),
        ([], "ftp://e.com/l", "https://e.com/h", None),
        ([("enclosure", None, "HTTPS://e.com/a")], None, None, None),
        (None, None, None, None),
        ([("enclosure", None, "  https://e.com/a.mp3  \n")], None, None, "https://e.com/a.mp3"),
    ],
)
def test_audio_url(spark, links, link, href, expected):
    given = entry(0, link=link, href=href)
    df = entries(spark, (*given[:5], links, *given[6:]))
    assert df.select(ingest.audio_url()).first()[0] == expected


def test_validate_episodes_keeps_the_good_ones(spark, rows):
    given = entries(
        spark, entry(0, title=" One "), entry(1, title=None), entry(2, title="  "), entry(3, links=[]),
        entry(4, parsed=None), entry(5, parsed=None, published="sometime"),
        entry(6, parsed=None, published="Sat, 11 May 2019 22:40:00 -0200"),
        entry(7, parsed=datetime(2024, 1, 1), published="Sat, 11 May 2019 22:40:00 +0000"),
        entry(8, podcast=None), entry(9, podcast=2, name=None), entry(10, podcast=3, title=""),
    )
    accepted, rejected = ingest.validate_episodes(given)
    assert rows(accepted, "feed_pos", "episode_title", "published_at", "transcribed") == [
        (0, "One", datetime(2024, 1, 15, 10, 30), False),
        (6, "Episode", datetime(2019, 5, 12, 0, 40), False),
        (7, "Episode", datetime(2024, 1, 1), False),
    ]
    assert dict(rows(rejected, "feed_pos", "reject_reason")) == {
        1: "title", 2: "title", 3: "audio_url", 4: "published", 5: "published", 8: "podcast_id",
        9: "podcast_name", 10: "title",
    }
    assert rows(ingest.podcasts_with_episodes(accepted, given)) == [(1, "Pod", 8, 3)]


# -- load ----------------------------------------------------------------------


def accepted_rows(spark, *given):
    data = [(p, f"P{p}", pos, f"T{pos}", url, datetime(2024, 1, 1), False) for p, pos, url in given]
    return spark.createDataFrame(
        data, "podcast_id bigint, podcast_name string, feed_pos bigint, episode_title string, audio_url string, "
        "published_at timestamp_ntz, transcribed boolean",
    )


def test_load_episodes_is_unique_over_all_podcasts(spark, rows):
    accepted = accepted_rows(
        spark, (2, 0, "x"), (1, 1, "x"), (1, 0, "y"), (1, 2, "old"), (9, 0, "z"), (None, 0, "n"), (1, 3, None),
        *[(3, i, "hot") for i in range(40)],
    )
    episodes = spark.createDataFrame([("old",)], "audio_url string")
    podcasts = spark.createDataFrame([(1,), (2,), (3,)], "podcast_id bigint")
    inserted, outcomes = ingest.load_episodes(accepted, episodes, podcasts)
    assert rows(inserted, "podcast_id", "audio_url", "episode_title") == [(1, "x", "T1"), (1, "y", "T0"), (3, "hot", "T0")]
    assert outcomes.count() == accepted.count()
    assert outcomes.filter("outcome = 'inserted'").count() == 3
    stats = {r["podcast_id"]: tuple(r)[2:] for r in ingest.load_stats(outcomes.filter("podcast_id is not null")).collect()}
    assert stats == {1: (1, 4, 2, 2), 2: (1, 1, 0, 1), 3: (1, 40, 1, 39), 9: (1, 1, 0, 1), None: (4, 46, 3, 43)}


def test_append_checks_ids(spark):
    accepted = accepted_rows(spark, (1, 0, "x"), (1, 1, "y"))
    podcasts = spark.createDataFrame([(1,)], "podcast_id bigint")
    none = spark.createDataFrame([], "audio_url string")
    inserted, _ = ingest.load_episodes(accepted, none, podcasts, F.lit(datetime(2024, 2, 2)))
    table = ingest.append_episodes(inserted.limit(0), inserted)
    assert table.count() == 2 and table.first()["uploaded_at"] == datetime(2024, 2, 2)
    with pytest.raises(ValueError):
        ingest.append_episodes(inserted.limit(0), inserted.withColumn("episode_id", F.lit(1)))
    # A row given twice is one row, in the table and in the report.
    twice, outcomes = ingest.load_episodes(accepted.unionByName(accepted), none, podcasts)
    assert twice.count() == outcomes.filter("outcome = 'inserted'").count() == outcomes.count() == 2
    with pytest.raises(ValueError, match="is taken"):
        ingest.append_episodes(inserted.withColumn("audio_url", F.lit("other")), inserted)


def test_cascade_delete(spark, rows):
    frame = lambda data, schema: spark.createDataFrame(data, schema)
    tables = {
        "podcast": frame([(1, 7), (2, 7), (3, None)], "podcast_id bigint, language_id bigint"),
        "language": frame([(7,), (8,)], "language_id bigint"),
        "episode": frame([(10, 1), (20, 2)], "episode_id bigint, podcast_id bigint"),
        "episode_topics": frame([(10, 5), (20, 5)], "episode_id bigint, topic_id bigint"),
        "episode_embedding": frame([(10, 0), (20, 0)], "episode_id bigint, chunk_index bigint"),
    }
    left = ingest.cascade_delete(
        tables, frame([(1,), (1,)], "podcast_id bigint"), frame([(7,)], "language_id bigint")
    )
    assert rows(left["podcast"]) == [(2, None), (3, None)]
    assert rows(left["language"]) == [(8,)]
    assert rows(left["episode"]) == [(20, 2)]
    assert rows(left["episode_topics"]) == [(20, 5)] and rows(left["episode_embedding"]) == [(20, 0)]
