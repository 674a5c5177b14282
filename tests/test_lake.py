import json
import os

import pytest
from pyspark.sql import functions as F

from earshot.plans import queries as registered
from earshot.sources import keyed, lake, lookups, tables


def put(folder, podcast, episode, content, name="data.jsonl"):
    path = os.path.join(folder, f"podcast_id={podcast}", f"episode_id={episode}")
    os.makedirs(path)
    with open(os.path.join(path, name), "w", encoding="utf-8", newline="") as f:
        f.write(content)


def line(text):
    return json.dumps({"transcript_text": text})


@pytest.fixture
def transcripts(folder):
    put(folder, 4, "007", line("one") + "\n")
    put(folder, 4, "008", "\n".join([line("a"), "", line("b"), line(""), json.dumps({"other": 1}), line("c")]) + "\n\n")
    return folder


def test_strict_and_keep_empty(spark, transcripts, rows):
    strict = rows(lake.read_transcripts(spark, transcripts, "strict"))
    # Keys are text, so leading zeros stay.
    assert strict == [("4", "007", "one"), ("4", "008", "a b c")]
    assert rows(lake.read_transcripts(spark, transcripts, "keep_empty")) == [
        ("4", "007", "one"), ("4", "008", "a b   c")
    ]
    lines = lake.read_transcript_lines(spark, transcripts, "strict")
    assert rows(lines.filter("episode_id = '008'"), "pos", "text") == [(0, "a"), (1, "b"), (2, "c")]
    assert rows(lake.assemble_transcripts(lines)) == strict


@pytest.mark.parametrize("policy", ["strict", "keep_empty"])
@pytest.mark.parametrize("bad", ["{broken", "[1]", "null", "5", line("x") + " more", line("x") + "," + line("y")])
def test_malformed_lines_fail(spark, folder, policy, bad):
    put(folder, 1, 1, line("a") + f"\n{bad}\n" + line("b"))
    with pytest.raises(Exception):
        lake.read_transcripts(spark, folder, policy).collect()


def test_line_of_blanks(spark, folder, rows):
    put(folder, 1, 1, line("a") + "\n   \n" + line("b"))
    assert rows(lake.read_transcripts(spark, folder, "strict"), "transcript_text") == [("a b",)]
    with pytest.raises(Exception, match="malformed"):
        lake.read_transcripts(spark, folder, "keep_empty").collect()


def test_file_without_text(spark, folder):
    put(folder, 1, 1, line("") + "\n" + json.dumps({"x": 1}))
    with pytest.raises(Exception, match="no transcript text for episode 1"):
        lake.read_transcripts(spark, folder, "strict").collect()
    assert lake.read_transcripts(spark, folder, "keep_empty").first()["transcript_text"] == " "


def test_strict_query_goes_on_without_textless_episodes(spark, folder, rows):
    """As its SQL does, which has no row for a document without a line of text."""
    said = [(1, "one\n\ntwo"), (2, ""), (3, "\n\n"), (4, " "), (5, None)]
    df = spark.createDataFrame([(i, "src", text) for i, text in said], "doc_id bigint, source string, text string")
    df.write.parquet(f"{folder}/documents.parquet")
    got = rows(registered.REGISTRY["transcripts_strict"](spark, folder))
    # A null document is no empty file; its row stays null.
    assert got == [("src", "1", "one two"), ("src", "4", " "), ("src", "5", None)]
    with pytest.raises(ValueError, match="unknown way"):
        lake.read_transcripts(spark, f"{folder}/documents.parquet", textless="drop")


def test_auto_goes_by_suffix(spark, folder, rows):
    put(folder, 1, 1, line("a") + "\n" + line("") + "\n" + line("b"))
    put(folder, 1, 2, "plain\ntext " * 1000, "transcript.txt")
    put(folder, 1, 3, "", "transcript.txt")
    got = dict(rows(lake.read_transcripts(spark, folder, format="auto"), "episode_id", "transcript_text"))
    assert got["1"] == "a  b" and got["2"] == "plain\ntext " * 1000
    # An empty file has no rows to scan.
    assert got.get("3", "") == ""


def test_unknown_options(spark, transcripts):
    with pytest.raises(ValueError):
        lake.read_transcripts(spark, transcripts, "lenient")
    with pytest.raises(ValueError):
        lake.read_transcripts(spark, transcripts, format="csv")


def test_segments_drop_malformed_lines(spark, folder, rows):
    good = json.dumps({"start_time": 0, "end_time": 10, "speaker": "A", "text": "Hello"})
    put(folder, 1, 2, good + "\n{nope\n\n  \nnull\n[]\n" + good + " x\n" + good + "\n")
    put(folder, 1, 3, json.dumps({"speaker": "B"}))
    got = lake.read_segments(spark, folder)
    assert rows(got) == [(0.0, 10.0, "A", "Hello", "1", "2")] * 2 + [(None, None, "B", None, "1", "3")]
    assert got.count() == 3
    assert lake.read_segments(spark, folder + "/absent").count() == 0


def test_jsonl_layout_has_one_ordered_file_per_episode(spark, folder, rows):
    df = spark.range(200).select(
        F.lit("p").alias("podcast_id"), F.concat(F.lit("0"), F.col("id") % 3).alias("episode_id"), "id",
        F.col("id").cast("string").alias("transcript_text"),
    ).repartition(7)
    lake.write_partitioned(df, f"{folder}/t", "jsonl", order="id")
    for episode in ("00", "01", "02"):
        names = [n for n in os.listdir(f"{folder}/t/podcast_id=p/episode_id={episode}") if n.startswith("part")]
        assert len(names) == 1
    got = dict(rows(lake.read_transcripts(spark, f"{folder}/t"), "episode_id", "transcript_text"))
    assert got["01"] == " ".join(str(i) for i in range(200) if i % 3 == 1)


def test_parquet_layout_round_trip(spark, folder, rows):
    df = spark.createDataFrame([("1", "1", "a"), ("1", "2", "b")], "podcast_id string, episode_id string, transcript_text string")
    lake.write_partitioned(df, f"{folder}/p")
    assert rows(lake.read_partitioned(spark, f"{folder}/p"), *df.columns) == rows(df)
    one = spark.read.parquet(f"{folder}/p").filter(lake.bucket_filter("1", "2"))
    assert one.first()["transcript_text"] == "b" and one.count() == 1
    with pytest.raises(ValueError):
        lake.write_partitioned(df, f"{folder}/x", "csv")


def test_summaries_have_defaults_and_replace_only_their_episodes(spark, folder, rows):
    schema = "podcast_id string, episode_id string, summary string, topics array<string>, speakers array<string>"
    frame = lambda *data: spark.createDataFrame(list(data), schema)
    lake.write_summaries(frame(("1", "1", "S", ["AI"], ["Ann"]), ("1", "2", None, None, None)), f"{folder}/s")
    lake.write_summaries(frame(("1", "2", "new", [], None)), f"{folder}/s")
    got = rows(lake.read_summaries(spark, f"{folder}/s"), "episode_id", "summary", "topics", "speakers")
    assert got == [("1", "S", ["AI"], ["Ann"]), ("2", "new", [], [])]
    for data in ((("1", "1", "S", ["AI"], ["Ann"]), ("1", "2", None, None, None)), (("1", "2", "new", [], None),)):
        lake.write_summaries(frame(*data), f"{folder}/j", "jsonl")
    assert rows(lake.read_summaries(spark, f"{folder}/j"), "episode_id", "summary", "topics", "speakers") == got


def test_registered_tables_follow_the_writers(spark, folder, rows):
    frame = lambda *data: spark.createDataFrame(list(data), "podcast_id string, episode_id string, transcript_text string")
    lake.write_partitioned(frame(("1", "01", "a"), ("1", "03", "c")), f"{folder}/transcripts", buckets=64)
    lake.write_summaries(
        frame(("1", "01", "a")).selectExpr("podcast_id", "episode_id", "transcript_text AS summary",
                                           "array('AI') AS topics", "array('Ann') AS speakers"),
        f"{folder}/summaries",
    )
    # Declared over other files earlier, without moving them.
    spark.sql(f"CREATE TABLE reg_summaries (old STRING) USING json LOCATION '{folder}/summaries'")
    names = lake.register_datasets(spark, folder, "reg_")
    assert names == ["reg_transcripts", "reg_summaries"]
    assert rows(spark.table("reg_summaries"), "topics") == [(["AI"],)]
    assert rows(spark.table("reg_transcripts"), "transcript_text", "podcast_id", "episode_id") == [("a", "1", "01"), ("c", "1", "03")]
    wider = frame(("1", "02", "b"), ("1", "03", "d")).withColumn("seconds", F.lit(7))
    report = lake.replace_episodes(wider, f"{folder}/transcripts")
    assert len(report.written) <= 2 and report.buckets == 64
    lake.register(spark, "reg_transcripts", report)
    got = rows(spark.table("reg_transcripts"), "episode_id", "transcript_text", "seconds")
    assert got == [("01", "a", None), ("02", "b", 7), ("03", "d", 7)]
    for name in names:
        spark.sql(f"DROP TABLE {name}")


def test_registered_table_follows_a_dataset_dealt_anew(spark, folder, rows):
    frame = spark.range(50).selectExpr("'p' AS podcast_id", "CAST(id AS STRING) AS episode_id", "'t' AS transcript_text")
    for buckets in (2, 8):
        report = lake.write_partitioned(frame, f"{folder}/t", buckets=buckets)
        lake.register(spark, "reg_dealt", report)
        assert spark.table("reg_dealt").count() == 50 and os.listdir(f"{folder}/t") == [f"buckets={buckets}"]
    spark.sql("DROP TABLE reg_dealt")


def test_replaced_keys_and_touched_buckets(spark, folder, rows):
    frame = lambda ids, text: spark.createDataFrame([(i, n, text) for i in ids for n in range(2)], "id bigint, n int, text string")
    files = lambda: {f"{d}/{f}" for d, _, names in os.walk(folder) for f in names if f.startswith("part-") and "_columns" not in d}
    first = keyed.replace(frame(range(100), "old"), f"{folder}/k", ["id"], "n")
    assert (first.buckets, first.written) == (1, [0])
    keyed.store(frame(range(100), "old"), f"{folder}/k", ["id"], buckets=16)
    before = files()
    report = keyed.replace(frame([3, 500], "new"), f"{folder}/k", ["id"], "n")
    changed = {int(f.split("/bucket=")[1].split("/")[0]) for f in before ^ files()}
    assert changed == set(report.written) and len(report.written) <= 2
    want = sorted([(i, n, "new" if i in (3, 500) else "old") for i in [*range(100), 500] for n in range(2)], key=repr)
    for _ in range(2):
        assert rows(keyed.read(spark, f"{folder}/k")) == want
        keyed.replace(frame([3, 500], "new"), f"{folder}/k", ["id"], "n")
    assert keyed.replace(frame([], "new"), f"{folder}/k", ["id"], "n").written == []
    assert rows(keyed.read(spark, f"{folder}/k")) == want


def test_buckets_grow_with_the_data(spark, folder, rows, monkeypatch):
    frame = lambda ids: spark.range(ids).selectExpr("id", "concat(sha2(string(id), 256), sha2(string(-id), 256)) AS text")
    monkeypatch.setattr(keyed, "BUCKET_BYTES", 2000)
    monkeypatch.setattr(keyed, "GROWTH", 2)
    counts = []
    for size in (20, 300, 3000):
        counts.append(keyed.replace(frame(size), f"{folder}/k", ["id"]).buckets)
        assert rows(keyed.read(spark, f"{folder}/k"), "id") == sorted([(i,) for i in range(size)], key=repr)
    assert counts[-1] > counts[0] and os.listdir(f"{folder}/k") == [f"buckets={counts[-1]}"]


def test_lookup_opens_the_asked_buckets_only(spark, folder, rows):
    df = spark.range(200).selectExpr("'p' AS podcast_id", "CAST(id AS STRING) AS episode_id", "concat('t', id) AS transcript_text")
    lake.write_partitioned(df, f"{folder}/t", buckets=32)
    asked = spark.createDataFrame([("p", 7), ("p", 999)], "podcast_id string, episode_id int")
    stored = lake.read_episodes(asked, f"{folder}/t")
    assert rows(lookups.lookup_transcripts(asked, stored)) == [("p", "7", "t7", "found"), ("p", "999", None, "missing")]
    assert len(stored.inputFiles()) <= 2 or stored.count() < 40
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert "bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
    one = spark.read.parquet(f"{folder}/t").filter(lake.bucket_filter("p", "7"))
    assert one.first()["transcript_text"] == "t7" and one.count() == 1


def test_packed_files_read_like_loose_ones(spark, transcripts, rows):
    put(transcripts, "a:b +%20é", "x=y", line("odd"))
    put(transcripts, 5, "1", line("one") + "\r\n" + line("two"), "data.json")
    put(transcripts, 5, "2", "plain\n", "transcript.txt")
    assert lake.pack_files(spark, transcripts, f"{transcripts}-packed").buckets == 1
    for policy in ("keep_empty", "auto"):
        options = {"format": "auto"} if policy == "auto" else {"policy": policy}
        good = "episode_id <> '2'" if policy == "keep_empty" else "true"
        loose, packed = (rows(lake.read_transcripts(spark, p, **options).filter(good)) for p in (transcripts, f"{transcripts}-packed"))
        assert loose == packed and ("a:b + é", "x=y", "odd") in loose and ("4", "007", "one") in loose
    # A folder packed again replaces its episodes.
    lake.pack_files(spark, transcripts, f"{transcripts}-packed")
    assert keyed.read(spark, f"{transcripts}-packed").count() == 5


def test_packed_segments(spark, folder, rows):
    good = json.dumps({"start_time": 0, "end_time": 10, "speaker": "A", "text": "Hello"})
    put(f"{folder}/s", 1, 2, good + "\n{nope\n\n  \nnull\n[]\r\n" + good + " x\n" + good + "\n")
    lake.pack_files(spark, f"{folder}/s", f"{folder}/p")
    assert rows(lake.read_segments(spark, f"{folder}/p")) == rows(lake.read_segments(spark, f"{folder}/s")) != []


def test_lookup_reads_the_asked_folders_only(spark, folder, rows):
    df = spark.range(20).selectExpr("'p' AS podcast_id", "CAST(id AS STRING) AS episode_id", "concat('t', id) AS transcript_text")
    lake.write_partitioned(df, f"{folder}/t", "jsonl")
    stored = spark.read.schema("transcript_text string, podcast_id string, episode_id string").json(f"{folder}/t")
    got = lookups.lookup_transcripts(spark.createDataFrame([("p", 7), ("p", 99)], "podcast_id string, episode_id int"), stored)
    assert rows(got) == [("p", "7", "t7", "found"), ("p", "99", None, "missing")]
    # Plans are cut at this width, and expression numbers take part of it.
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    plan = got.select("*")._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "dynamicprun" in plan.split("PartitionFilters: [")[1].split("\n")[0]


def test_lookups(spark, rows):
    stored = spark.createDataFrame(
        [("1", "1", "text"), ("1", "2", ""), ("1", "3", None)], "podcast_id string, episode_id string, transcript_text string"
    )
    keys = spark.createDataFrame([(1, 1), (1, 2), (1, 3), (2, 1), (1, 1)], "podcast_id bigint, episode_id bigint")
    assert rows(lookups.lookup_transcripts(keys, stored), "podcast_id", "episode_id", "status") == [
        ("1", "1", "found"), ("1", "2", "empty"), ("1", "3", "empty"), ("2", "1", "missing")
    ]
    summaries = stored.select("podcast_id", "episode_id", F.col("transcript_text").alias("summary"),
                              F.array(F.lit("AI")).alias("topics"), F.array(F.lit("Ann")).alias("speakers"))
    got = lookups.lookup_summaries(keys, summaries).filter("status = 'found'").first()
    assert (got["summary"], got["topics"], got["speakers"]) == ("text", ["AI"], ["Ann"])


def test_coverage(spark, rows):
    episodes = spark.createDataFrame([(1,), (2,)], "episode_id bigint")
    stored = spark.createDataFrame([("1",), ("1",)], "episode_id string")
    assert rows(lookups.transcript_coverage(episodes, stored)) == [(1, True), (2, False)]


def test_snapshots(spark, folder, rows):
    topics = lambda *names: spark.createDataFrame([(i, n) for i, n in enumerate(names)], "topic_id bigint, topic_name string")
    assert tables.read_snapshot(spark, folder, "topics").count() == 0
    assert tables.publish_next(spark, folder, {"topics": topics("a")}) == {"topics": 1}
    # The next version is computed from the one it follows.
    grown = tables.read_snapshot(spark, folder, "topics").unionByName(topics("b").withColumn("topic_id", F.lit(9)))
    assert tables.publish_next(spark, folder, {"topics": grown}) == {"topics": 2}
    assert rows(tables.read_snapshot(spark, folder, "topics"), "topic_name") == [("a",), ("b",)]
    # A version without success marker was not finished: a crash before the manifest changes nothing.
    os.makedirs(f"{folder}/_manifest/version=3")
    topics("lost").write.parquet(f"{folder}/topics/version=3-lost")
    assert tables.current_version(spark, folder) == 2
    assert rows(tables.read_snapshot(spark, folder, "topics"), "topic_name") == [("a",), ("b",)]


def test_tables_are_published_together(spark, folder, rows):
    topics = lambda *names: spark.createDataFrame([(i, n) for i, n in enumerate(names)], "topic_id bigint, topic_name string")
    links = lambda n: spark.createDataFrame([(n, n)], "episode_id bigint, topic_id bigint")
    assert tables.publish(spark, folder, replaced={"topics": topics("a"), "episode_topics": links(1)}) == 1
    assert tables.publish(spark, folder, appended={"topics": topics("b"), "episode_topics": links(2)}) == 2
    assert tables.publish(spark, folder, replaced={"topics": topics("c")}) == 3
    names = lambda version: [r[0] for r in rows(tables.read_snapshot(spark, folder, "topics", version), "topic_name")]
    assert [names(v) for v in (1, 2, 3, None)] == [["a"], ["a", "b"], ["c"], ["c"]]
    assert tables.read_snapshot(spark, folder, "episode_topics").count() == 2
    # The second of two jobs that start from the same version fails.
    before = tables.current_version
    tables.current_version = lambda *_: 2
    try:
        with pytest.raises(Exception, match="(?i)exists"):
            tables.publish(spark, folder, appended={"topics": topics("x")})
    finally:
        tables.current_version = before
    assert names(None) == ["c"]
    assert len(tables.remove_old_versions(spark, folder, keep=1)) == 3
    assert names(3) == ["c"] and tables.read_snapshot(spark, folder, "episode_topics").count() == 2
    merged = tables.publish(spark, folder, appended={"episode_topics": links(3)}, most_folders=2)
    assert len(tables.table_folders(spark, folder, merged)["episode_topics"]) == 1
    assert tables.read_snapshot(spark, folder, "episode_topics").count() == 3


def test_read_table_and_unique_check(spark, folder, rows):
    spark.createDataFrame([(1, "a"), (2, "a")], "topic_id bigint, topic_name string").write.parquet(f"{folder}/topics")
    df = tables.read_table(spark, folder, "topics")
    assert rows(df) == [(1, "a"), (2, "a")]
    assert rows(tables.check_unique(df, "topic_name")) == [("a", 2)]
