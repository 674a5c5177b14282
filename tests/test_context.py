import random
from datetime import datetime
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from earshot.operators import context as c
from earshot.operators import keywords


def test_chunk_context(spark, rows):
    hits = spark.createDataFrame(
        [(1, 2, 8, "second"), (1, 1, 3, "first"), (1, 6, 9, "sixth")],
        "query_id bigint, rank int, chunk_index int, chunk_text string",
    )
    asked = spark.createDataFrame([(1,), (2,)], "query_id bigint")
    assert rows(c.chunk_context(hits, asked)) == [(1, "[Chunk 3]: first\n\n[Chunk 8]: second"), (2, "")]


def test_percent_is_rounded_by_the_binary_value(spark):
    dice = random.Random(2)
    scores = [0.1235, 0.0005, 0.8755, 0.125, 0.0625, 0.9995, 1.0, 0.0, -0.1235, -1.0, 0.99949999]
    scores += [dice.randrange(20001) / 20000 for _ in range(1500)] + [dice.uniform(-1, 1) for _ in range(500)]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(scores)], "i int, s double")
    got = [r[0] for r in df.orderBy("i").select(c._percent(F.col("s"))).collect()]
    assert [g for g in got] == [f"{s:.1%}"[:-1].replace("-0.0", "0.0") for s in scores]


def similar(spark):
    return spark.createDataFrame(
        [(1, 2, "B", "Pod", 0.5), (1, 1, "A", "Pod", 0.8734), (1, 3, "C", "Pod", 1.0)],
        "query_id bigint, rank int, episode_title string, podcast_name string, similarity_score double",
    )


def test_similar_context(spark, rows):
    asked = spark.createDataFrame([(1,), (2,)], "query_id bigint")
    heading = "\n\n**Similar Episodes Available:**\n"
    expected = heading + "".join(
        f"- {t} (Pod) - Similarity: {s:.1%}\n" for t, s in (("A", 0.8734), ("B", 0.5), ("C", 1.0))
    )
    assert rows(c.similar_context(similar(spark), asked)) == [(1, expected), (2, "")]


@pytest.mark.parametrize(
    "message, expected",
    [
        ("which ones would you recommend next", True), ("anything else like this out there", True),
        ("list the related episodes", True), ("ReCoMmEnD!", True), ("not SIMILAR at all", True),
        ("who is speaking here", False), ("when did they meet", False),
        ("summarise the second half", False), ("", False), (None, False),
    ],
)
def test_intent(spark, message, expected):
    df = spark.createDataFrame([(message,)], "m string")
    assert df.select(c.asks_for_similar(F.col("m"))).first()[0] is expected


def test_list_only_where_asked_for(spark, rows):
    messages = spark.createDataFrame([(1, "similar?"), (1, "what?"), (2, "recommend")], "query_id bigint, message string")
    chunks = spark.createDataFrame([(1, "ctx")], "query_id bigint, context string")
    recommended = spark.createDataFrame([(1, "list")], "query_id bigint, similar_episodes string")
    got = c.with_context(messages, chunks, recommended)
    assert rows(got, "message", "context", "similar_episodes") == [
        ("recommend", "", ""), ("similar?", "ctx", "list"), ("what?", "ctx", "")
    ]


def test_recent_turns(spark):
    talk = spark.createDataFrame(
        [(1, i, "user", f"turn no {i}") for i in range(15)] + [(2, 0, "user", "only")],
        "conv_id bigint, turn bigint, role string, text string",
    )
    got = c.recent_turns(talk).filter("conv_id = 1").orderBy("position").collect()
    assert [r["text"] for r in got] == [f"turn no {i}" for i in range(5, 15)]
    asked = spark.createDataFrame([(1, "now")], "conv_id bigint, message string")
    request = [r["text"] for r in c.chat_request(talk, asked, 2).collect()]
    assert request == ["turn no 13", "turn no 14", "now", "only"]


@pytest.mark.parametrize("block", [1, 4096])
def test_keyword_search(spark, folder, rows, monkeypatch, block):
    monkeypatch.setattr(keywords, "BLOCK_TEXTS", block)
    episodes = spark.createDataFrame([(1, "All about AI"), (2, "100% pure"), (3, "x")], "episode_id bigint, episode_title string")
    texts = spark.createDataFrame([(1, "nothing"), (2, "hair_style"), (3, "HAIR and ÉTÉ")], "episode_id bigint, transcript_text string")
    words = spark.createDataFrame(
        [(1, "ai"), (2, "0% P"), (3, "_"), (4, "été"), (5, ""), (6, None), (7, "%"), (8, "AI"), (9, "air"), (10, "hair_xtyle"), (11, "nothing at all"), (12, "style")],
        "query_id bigint, keyword string",
    )
    got = keywords.keyword_search(words, episodes, texts)
    assert sorted(rows(got, "query_id", "episode_id", "in_title", "in_transcript")) == [
        (1, 1, True, False), (1, 2, False, True), (1, 3, False, True), (2, 2, True, False), (3, 2, False, True),
        (4, 3, False, True), (7, 2, True, False), (8, 1, True, False), (8, 2, False, True), (8, 3, False, True),
        (9, 2, False, True), (9, 3, False, True), (12, 2, False, True),
    ]
    keywords.store_postings(keywords.searched_texts(episodes, texts), f"{folder}/p")
    stored = keywords.keyword_search(words, episodes, texts, f"{folder}/p")
    assert rows(stored) == rows(got)
    assert keywords.keyword_search(words.limit(0), episodes, texts).count() == 0
    assert keywords.keyword_search(words, episodes.limit(0), texts.limit(0)).count() == 0


def test_posting_lists_are_smaller_than_the_texts(spark, folder, monkeypatch):
    monkeypatch.setattr(keywords, "WORDS_TOGETHER", 2)
    dice = random.Random(5)
    said = [" ".join(dice.choices(("alpha", "béta", "gamma", "delta", "ﬁ😀", "omega"), k=dice.randrange(1, 60))) for _ in range(400)]
    texts = spark.createDataFrame(list(enumerate(said)), "episode_id bigint, transcript_text string")
    episodes = spark.createDataFrame([(i, f"No {i}") for i in range(400)], "episode_id bigint, episode_title string")
    keywords.store_postings(keywords.searched_texts(episodes, texts).coalesce(1), f"{folder}/p")
    stored = sum(f.stat().st_size for f in Path(folder).rglob("*.parquet"))
    assert stored < sum(len(text) for text in said)
    words = ["alpha gamma", "a o", "i😀 de", "éta", "a\0", "o 39", "zeta", "ega delta b"]
    asked = spark.createDataFrame(list(enumerate(words)), "query_id bigint, keyword string")
    got = keywords.keyword_search(asked, episodes, texts, f"{folder}/p").collect()
    assert sorted((r["query_id"], r["episode_id"], r["in_title"], r["in_transcript"]) for r in got) == sorted(
        (q, i, word in f"no {i}", word in text)
        for q, word in enumerate(words) for i, text in enumerate(said) if word in f"no {i}" or word in text
    )


def test_grams_of_a_block():
    texts = ["abcab", "b", "\0b\0", "é😀é"]
    grams, starts, places = keywords._block_lists(texts)
    lists = {g: places[a:b].tolist() for g, a, b in zip(grams, starts, starts[1:])}
    pieces = [{t[i : i + n] for n in (1, 2, 3) for i in range(len(t) - n + 1)} for t in texts]
    assert lists == {g: [i for i, p in enumerate(pieces) if g in p] for g in set().union(*pieces)}


@pytest.mark.parametrize("table", [0, 40, 1 << 19])
@pytest.mark.parametrize("stretch", [5, 1 << 17])
def test_words_of_a_text_are_looked_for_together(monkeypatch, table, stretch):
    monkeypatch.setattr(keywords, "TABLE", table)
    monkeypatch.setattr(keywords, "STRETCH", stretch)
    dice = random.Random(11)
    texts = ["".join(dice.choices("abé😀\0 ", k=dice.randrange(0, 70))) for _ in range(60)] + ["", "aaaa", "ab", "\uffff"]
    words = list(dict.fromkeys("".join(dice.choices("abé😀\0", k=dice.randrange(1, 6))) for _ in range(90))) + ["aaaaaaaa", "z", "ab é"]
    found = keywords._contained(keywords._tree(words), texts, len(words))
    assert found.tolist() == [[word in text for word in words] for text in texts]


def test_tables_of_long_words_stay_small():
    dice = random.Random(7)
    words = ["".join(dice.choices("abcdefghijklmnopqrstuvwxyz", k=300)) for _ in range(500)]
    tree = keywords._tree(words)
    assert sum(level.table.nbytes for level in tree.levels if level.table is not None) <= 4 * keywords.TABLE
    text = words[3] + words[8][:-1] + words[77]
    assert np.flatnonzero(keywords._contained(tree, [text], len(words))[0]).tolist() == [3, 77]


def test_every_word_is_not_looked_for_by_itself(spark, folder):
    """Long texts hold the grams of most words, so a pass over a text for each of them is texts times words."""
    dice = random.Random(3)
    syllables = ["".join(dice.choices("abcdefghij", k=3)) for _ in range(40)]
    said = [" ".join("".join(dice.choices(syllables, k=2)) for _ in range(3000)) for _ in range(60)]
    words = list(dict.fromkeys("".join(dice.choices(syllables, k=3)) for _ in range(3000)))
    texts = spark.createDataFrame(list(enumerate(said)), "episode_id bigint, transcript_text string").repartition(1)
    episodes = spark.createDataFrame([(i, f"No {i}") for i in range(60)], "episode_id bigint, episode_title string")
    asked = spark.createDataFrame(list(enumerate(words)), "query_id bigint, keyword string")
    found = keywords.keyword_search(asked, episodes, texts)
    plan = found._jdf.queryExecution().optimizedPlan().toString().lower()
    # No `contains` per candidate word is left in the plan; the words of a text are verified in one function.
    assert "contains(" not in plan and "mapinarrow" in plan
    want = {(q, i) for q, word in enumerate(words) for i, text in enumerate(said) if word in text}
    assert {(r["query_id"], r["episode_id"]) for r in found.collect()} == want


def test_facets(spark, rows):
    frame = lambda data, schema: spark.createDataFrame(data, schema)
    tables = {
        "episode": frame(
            [(i, i % 2, f"T{i}", f"2024-01-0{i}") for i in (1, 2, 3, 4)],
            "episode_id bigint, podcast_id bigint, episode_title string, at string",
        ).withColumn("published_at", F.col("at").cast("timestamp_ntz")),
        "podcast": frame([(0, "Even"), (1, "Odd")], "podcast_id bigint, podcast_name string"),
        "topics": frame([(1, "AI"), (2, "Tech")], "topic_id bigint, topic_name string"),
        "episode_topics": frame([(1, 1), (1, 2), (2, 1), (3, 2)], "episode_id bigint, topic_id bigint"),
        "speakers": frame([(1, "Ann")], "speaker_id bigint, speaker_name string"),
        "episode_speakers": frame([(2, 1), (3, 1)], "episode_id bigint, speaker_id bigint"),
    }
    ids = lambda **facets: [r[0] for r in rows(c.filter_episodes(tables, **facets), "episode_id")]
    assert ids() == [1, 2, 3, 4]
    assert ids(topics=["AI"]) == [1, 2] and ids(topics=["AI", "Tech"]) == [1, 2, 3]
    assert ids(topics=["AI", "Tech"], speakers=["Ann"]) == [2, 3]
    assert ids(topics=["AI", "Tech"], speakers=["Ann"], podcasts=["Even"]) == [2]
    assert ids(since=datetime(2024, 1, 2), until=datetime(2024, 1, 3)) == [2, 3]
