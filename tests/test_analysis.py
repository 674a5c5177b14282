import json

from earshot.operators import analysis as a

SEGMENTS = "episode_id bigint, pos int, speaker string, text string"


def python_samples(segments, limit):
    samples = {}
    for _, _, speaker, text in sorted(segments, key=lambda s: s[1]):
        text = (text or "").strip()
        if speaker and text:
            said = samples.setdefault(speaker, "")
            if len(said) < limit:
                samples[speaker] = said + text + " "
    return {who: said[:limit].strip() for who, said in samples.items()}


def test_speaker_samples(spark):
    segments = [(1, i, "A" if i % 3 == 0 else f"S{i % 2}", f" part {i} " * (i % 5)) for i in range(900)]
    segments += [(1, 900, None, "x"), (1, 901, "", "x"), (1, 902, "Quiet", "  "), (1, 903, "Long", "y" * 2000)]
    for limit in (500, 37):
        got = a.speaker_samples(spark.createDataFrame(segments, SEGMENTS).repartition(5), limit).collect()
        assert {r["speaker"]: r["sample"] for r in got} == python_samples(segments, limit)


def test_requests(spark):
    transcripts = spark.createDataFrame([(1, "w" * 28_000), (2, "short")], "episode_id bigint, transcript_text string")
    segments = [(1, 0, "B", "first"), (1, 1, "A", "second")]
    samples = a.speaker_samples(spark.createDataFrame(segments, SEGMENTS))
    got = {r["episode_id"]: r for r in a.analysis_requests(transcripts, samples).collect()}
    assert len(got[1]["transcript"]) == 10_000 and len(got[1]["request"]) < 12_000
    assert got[1]["speaker_block"].index("Speaker B said") < got[1]["speaker_block"].index("Speaker A said")
    assert got[2]["request"] == "short" and got[2]["speaker_block"] == ""
    assert a.analysis_requests(transcripts).filter("episode_id = 2").first()["request"] == "short"


def test_parse_analysis(spark):
    answers = {
        1: json.dumps({"topics": ["AI", "ml"], "summary": "S", "speakers": [{"name": " Ann "}, {"name": "Bob", "x": 1}]}),
        2: json.dumps({"topics": ["AI"]}),
        3: "{}",
        4: "not json",
        5: "[1]",
        6: json.dumps({"speakers": ["Ann", {"name": 5}, {"name": " "}, {"nick": "x"}, {"name": None}, 7,
                                    '{"name": "text"}', {"name": "Cy"}]}),
        7: None,
        8: '{"topics": []} and more',
        9: '{"topics": []}, {}',
        10: " {} ",
    }
    df = spark.createDataFrame(list(answers.items()), "episode_id bigint, response string")
    got = {r["episode_id"]: tuple(r)[1:] for r in a.parse_analysis(df).collect()}
    assert got[1] == ("parsed", ["AI", "ml"], "S", ["Ann", "Bob"])
    assert got[2] == ("parsed", ["AI"], "", [])
    assert got[3] == ("parsed", [], "", [])
    for failed in (4, 5, 7, 8, 9):
        assert got[failed] == ("failed", None, None, None)
    assert got[10] == got[3]
    assert got[6] == ("parsed", [], "", ["Cy"])


def test_topics_are_case_sensitive_and_linked_once(spark, rows):
    analysis = spark.createDataFrame(
        [(1, ["AI", "ai", "AI", "Health"]), (2, ["Health"]), (3, [])], "episode_id bigint, topics array<string>"
    )
    topics = spark.createDataFrame([(7, "Health")], "topic_id bigint, topic_name string")
    links = spark.createDataFrame([(2, 7), (9, 7)], "episode_id bigint, topic_id bigint")
    table, bridge = a.upsert_topics(analysis, topics, links)
    assert rows(table, "topic_name") == [("AI",), ("Health",), ("ai",)]
    assert rows(bridge.join(table, "topic_id"), "episode_id", "topic_name") == [
        (1, "AI"), (1, "Health"), (1, "ai"), (2, "Health"), (9, "Health")
    ]
    again, same = a.upsert_topics(analysis, table, bridge)
    assert rows(again) == rows(table) and rows(same) == rows(bridge)


def test_speakers_ignore_case(spark, rows):
    analysis = spark.createDataFrame(
        [(1, ["Jane Doe", "JANE DOE"]), (2, ["jane doe", "Bob"]), (3, ["BOB"])], "episode_id bigint, speakers array<string>"
    )
    columns = "speaker_id bigint, speaker_name string, speaker_username string"
    speakers = spark.createDataFrame([(5, "bob", None), (4, "BoB", None)], columns)
    none = spark.createDataFrame([], "episode_id bigint, speaker_id bigint")
    table, bridge = a.upsert_speakers(analysis, speakers, none)
    assert rows(table, "speaker_name") == [("BoB",), ("Jane Doe",), ("bob",)]
    assert rows(bridge.join(table, "speaker_id"), "episode_id", "speaker_name") == [
        (1, "Jane Doe"), (2, "BoB"), (2, "Jane Doe"), (3, "BoB")
    ]


def test_store_and_read_back(spark, rows):
    analysis = spark.createDataFrame(
        [(1, ["B", "A"], ["Ann"]), (2, None, ["Bob"]), (3, ["A"], None), (9, ["C"], [])],
        "episode_id bigint, topics array<string>, speakers array<string>",
    )
    episodes = spark.createDataFrame([(1,), (2,), (3,)], "episode_id bigint")
    empty = {
        "topics": spark.createDataFrame([], "topic_id bigint, topic_name string"),
        "speakers": spark.createDataFrame([], "speaker_id bigint, speaker_name string, speaker_username string"),
        "episode_topics": spark.createDataFrame([], "episode_id bigint, topic_id bigint"),
        "episode_speakers": spark.createDataFrame([], "episode_id bigint, speaker_id bigint"),
    }
    assert dict(rows(a.analysis_status(analysis, episodes), "episode_id", "status")) == {
        1: "stored", 2: "topics missing", 3: "stored", 9: "episode missing"
    }
    stored = a.store_analysis(analysis, episodes, empty)
    a.check_analysis_ids(stored)
    back = a.episode_analysis(episodes, **stored)
    assert rows(back, "episode_id", "topics", "speakers", "summary") == [
        (1, ["A", "B"], ["Ann"], None), (2, [], [], None), (3, ["A"], [], None)
    ]
