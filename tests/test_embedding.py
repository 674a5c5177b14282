import pytest
from pyspark.sql import functions as F

from earshot.operators import embedding as e


@pytest.mark.parametrize(
    "given, reason",
    [("x" * 100, None), ("  " + "x" * 100 + "\n", None), ("x" * 99, "too short"), (" " + "x" * 99 + " ", "too short"),
     ("   ", "empty"), ("", "empty"), (None, "empty")],
)
def test_gate(spark, given, reason):
    df = spark.createDataFrame([(given,)], "transcript_text string")
    assert e.gate_transcripts(df).first()["reject_reason"] == reason


def test_gate_minimum(spark):
    df = spark.createDataFrame([("x" * 50,)], "transcript_text string")
    assert e.gate_transcripts(df, 50).first()["reject_reason"] is None


def tokens(spark, *lengths):
    data = [(i, [str(t) for t in range(n)]) for i, n in enumerate(lengths)]
    return spark.createDataFrame(data, "episode_id bigint, tokens array<string>")


@pytest.mark.parametrize("n, size, overlap", [(200, 50, 25), (1, 512, 256), (512, 512, 256), (513, 512, 256), (10, 3, 0), (10, 3, 2)])
def test_chunks_equal_a_plain_loop(spark, n, size, overlap):
    chunks, rejected = e.chunk_transcripts(tokens(spark, n), size, overlap)
    expected, start = [], 0
    while start < n:
        part = [str(t) for t in range(n)][start : start + size]
        expected.append((0, len(expected), " ".join(part), len(part), start, start + size))
        start += size - overlap
    assert [tuple(r) for r in chunks.orderBy("chunk_index").collect()] == expected
    assert rejected.count() == 0


def test_empty_episodes_are_rejected(spark, rows):
    df = tokens(spark, 0, 4).unionByName(spark.createDataFrame([(7, None)], "episode_id bigint, tokens array<string>"))
    chunks, rejected = e.chunk_transcripts(df, 2, 1)
    assert rows(rejected) == [(0, "empty"), (7, "empty")]
    assert chunks.count() == 4


@pytest.mark.parametrize("size, overlap", [(10, 10), (10, 11), (0, 0), (10, -1)])
def test_overlap_must_be_smaller_than_size(spark, size, overlap):
    with pytest.raises(ValueError):
        e.chunk_transcripts(tokens(spark, 5), size, overlap)


def chunk_frame(spark, data):
    return spark.createDataFrame(data, "episode_id bigint, chunk_index int, chunk_text string")


def test_one_failed_chunk_takes_its_episode_out(spark, rows):
    chunks = chunk_frame(spark, [(1, 0, "a b"), (1, 1, "c"), (2, 0, "good"), (2, 1, "  "), (3, 0, "bad"), (3, 1, "fine")])

    def embedder(df):
        vector = F.when(F.col("chunk_text") != "bad", F.array(F.lit(1.0).cast("float")))
        return df.withColumn("transcript_embedding", vector)

    embedded, failed = e.embed_chunks(chunks, embedder)
    assert rows(embedded, "episode_id", "chunk_index") == [(1, 0), (1, 1)]
    assert rows(failed) == [(2, 1), (3, 1)]


def test_hashing_embedder_gives_unit_vectors(spark):
    chunks = chunk_frame(spark, [(1, 0, "a b a"), (1, 1, "c")])
    embedded, _ = e.embed_chunks(chunks, e.hashing_embedder(32))
    for row in embedded.collect():
        assert len(row["transcript_embedding"]) == 32
        assert sum(x * x for x in row["transcript_embedding"]) == pytest.approx(1.0, abs=1e-5)


def test_a_failing_batch_costs_only_the_texts_that_fail(spark, rows):
    chunks = chunk_frame(spark, [(i, n, "bad" if (i, n) == (3, 1) else "ab" * (i + n)) for i in range(1, 9) for n in range(2)])

    def make_model():
        def model(texts):
            if "bad" in list(texts):
                raise RuntimeError("refused")
            return [[float(len(t)), float(t.count("a"))] for t in texts]

        return model

    embedded, failed = e.embed_chunks(chunks, e.batch_embedder(make_model, 4))
    want = [(i, n, [2.0 * (i + n), 1.0 * (i + n)]) for i in range(1, 9) for n in range(2) if i != 3]
    assert rows(embedded, "episode_id", "chunk_index", "transcript_embedding") == sorted(want, key=repr)
    assert rows(failed) == [(3, 1)]


def vectors(spark, *data):
    return spark.createDataFrame(
        [(ep, i, f"t{ep}-{i}", None if n is None else [0.5] * n) for ep, i, n in data],
        "episode_id bigint, chunk_index bigint, chunk_text string, transcript_embedding array<float>",
    )


def test_whole_episode_is_invalid(spark, rows):
    chunks = vectors(spark, (1, 0, 4), (1, 1, 4), (2, 0, 4), (2, 1, 3), (3, 0, None), (4, 0, 4))
    everyone = spark.createDataFrame([(i,) for i in range(1, 6)], "episode_id bigint")
    verdict = e.validate_embeddings(chunks, 4, everyone)
    assert rows(verdict) == [(1, 2, True), (2, 2, False), (3, 1, False), (4, 1, True), (5, 0, False)]
    assert rows(e.keep_valid(chunks, verdict), "episode_id", "chunk_index") == [(1, 0), (1, 1), (4, 0)]
    assert rows(e.validate_embeddings(vectors(spark, (1, 0, 1536))), "is_valid") == [(True,)]


def test_replace_removes_old_chunks(spark, rows):
    current = vectors(spark, (1, 0, 4), (1, 1, 4), (1, 2, 4), (2, 0, 4))
    new = vectors(spark, (1, 0, 2), (9, 0, 2))
    episodes = spark.createDataFrame([(1,), (2,)], "episode_id bigint")
    table, unknown = e.replace_embeddings(new, current, episodes)
    got = rows(table.select("episode_id", "chunk_index", F.size("transcript_embedding")))
    assert got == [(1, 0, 2), (2, 0, 4)]
    assert rows(unknown) == [(9,)]
