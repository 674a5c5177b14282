"""Search against brute force, ties and hot episodes included."""

import tempfile
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from earshot.operators import quantised, scoring, search
from earshot.operators.scoring import Ranking, best_matches
from earshot.plans import queries as registered
from earshot.plans.binding import Domain

DIM = 8


@pytest.fixture(scope="module")
def corpus(spark):
    """600 chunks; episode 0 holds a third of them and many vectors are copies."""
    rng = np.random.default_rng(5)
    base = rng.normal(size=(40, DIM)).astype("float32")
    rows = []
    for i in range(600):
        episode = 0 if i % 3 == 0 else i % 30 + 1
        rows.append((episode, i, f"chunk {i}", base[rng.integers(40)].tolist()))
    rows.append((77, 0, "no direction", [0.0] * DIM))
    rows.append((78, 0, "no vector", None))
    df = spark.createDataFrame(
        rows, "episode_id bigint, chunk_index bigint, chunk_text string, transcript_embedding array<float>"
    ).repartition(6)
    return df, rows


@pytest.fixture(scope="module")
def tables(spark):
    ids = [*range(31), 77, 78]
    episodes = spark.createDataFrame(
        [(i, i % 4, f"Episode {i}") for i in ids], "episode_id bigint, podcast_id bigint, episode_title string"
    ).withColumn("published_at", F.lit("2024-01-01").cast("timestamp_ntz"))
    podcasts = spark.createDataFrame([(i, f"Pod {i % 2}") for i in range(4)], "podcast_id bigint, podcast_name string")
    return episodes, podcasts


@pytest.fixture(scope="module")
def queries(spark):
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=DIM).tolist()) for i in range(7)] + [(7, [0.0] * DIM)]
    return spark.createDataFrame(rows, "query_id bigint, query_vector array<double>"), rows


def similarity(q, v):
    q, v = np.array(q, float), np.array(v, float)
    length = np.linalg.norm(q) * np.linalg.norm(v)
    return round(float(q @ v / length), 9) if length else None


def brute(queries, chunks, k, threshold=None, per_episode=False, own=None, within=None):
    out = set()
    for qid, q in queries:
        scored = []
        for episode, index, _, v in chunks:
            if v is None or (own and episode == own[qid]) or (within and episode != within[qid]):
                continue
            s = similarity(q, v)
            if s is not None and (threshold is None or s > threshold):
                scored.append((s, episode, index))
        if per_episode:
            best = {}
            for s, episode, _ in scored:
                best[episode] = max(s, best.get(episode, -9))
            scored = [(s, episode, 0) for episode, s in best.items()]
        scored.sort(key=lambda r: (-r[0], r[1], r[2]))
        out |= {(qid, rank, e, c) for rank, (_, e, c) in enumerate(scored[:k], 1)}
    return out


WAYS = [{}, {"max_query_bytes": 200}]


def picked(hits, chunk=True):
    columns = ["query_id", "rank", "episode_id", "chunk_index" if chunk else F.lit(0)]
    return {tuple(r) for r in hits.select(*columns).collect()}


@pytest.mark.parametrize("options", WAYS)
def test_best_chunks(corpus, queries, options):
    got = picked(best_matches(queries[0], corpus[0], Ranking(5, threshold=0.1), **options).frame)
    assert got == brute(queries[1], corpus[1], 5, 0.1)


@pytest.mark.parametrize("options", WAYS)
def test_best_episodes(corpus, queries, tables, options):
    got = search.search_episodes(queries[0], corpus[0], *tables, top_k=4, **options)
    assert picked(got, chunk=False) == brute(queries[1], corpus[1], 4, per_episode=True)


def test_within_one_episode(spark, corpus, queries):
    asked = {qid: (0 if qid < 5 else qid) for qid, _ in queries[1]}
    pairs = spark.createDataFrame(list(asked.items()), "query_id bigint, episode_id bigint")
    got = search.search_within(queries[0].join(pairs, "query_id"), corpus[0], 3)
    assert picked(got) == brute(queries[1], corpus[1], 3, within=asked)


@pytest.mark.parametrize("options", WAYS)
def test_similar_episodes_leave_themselves_out(spark, corpus, tables, options):
    ids = spark.createDataFrame([(0,), (3,), (78,), (999,)], "episode_id bigint")
    got = search.similar_episodes(corpus[0], *tables, ids, top_k=6, **options)
    anchors = [(e, min((c, v) for ee, c, _, v in corpus[1] if ee == e)[1]) for e in (0, 3)]
    assert picked(got, chunk=False) == brute(anchors, corpus[1], 6, per_episode=True, own={0: 0, 3: 3})


def test_many_queries_few_chunks(spark, corpus):
    """More queries than chunks."""
    few = corpus[0].filter("chunk_index < 60")
    rng = np.random.default_rng(8)
    rows = [(i, i % 31, rng.normal(size=DIM).tolist()) for i in range(500)]
    asked = spark.createDataFrame(rows, "query_id bigint, episode_id bigint, query_vector array<double>")
    got = search.search_within(asked, few, 2)
    chunks = [r for r in corpus[1] if r[1] < 60]
    assert picked(got) == brute([(i, q) for i, _, q in rows], chunks, 2, within={i: e for i, e, _ in rows})


def test_search_reports_names_and_trimmed_text(corpus, queries, tables):
    lower = corpus[0].withColumn("chunk_text", F.concat(F.lit("tail end. Now "), F.col("chunk_text")))
    got = search.search_chunks(queries[0], lower, *tables, threshold=0.1).collect()
    assert got and all(r["chunk_text"].startswith("Now chunk") for r in got)
    assert all(r["podcast_name"].startswith("Pod") and r["similarity"] > 0.1 for r in got)


def test_distance_ranking(corpus, queries, tables):
    got = search.search_chunks(queries[0], corpus[0], *tables, limit=3, threshold=None, metric="l2")
    want = set()
    for qid, q in queries[1]:
        scored = sorted(
            (round(float(np.linalg.norm(np.array(q) - np.array(v, float))), 9), e, c)
            for e, c, _, v in corpus[1] if v is not None
        )
        want |= {(qid, r, e, c) for r, (_, e, c) in enumerate(scored[:3], 1)}
    assert picked(got) == want


def test_approximate_search(corpus, queries):
    df = corpus[0]
    centers = search.train_cells(df, n_cells=8)
    cells = search.store_cells(df, centers, f"{tempfile.mkdtemp(prefix='earshot-cells-')}/cells")
    assert cells.count() == 601
    exact = brute(queries[1], corpus[1], 5)
    # The vector without direction sits in some cell but never matches.
    assert picked(search.ann_search(queries[0], cells, centers, 5, len(centers))) == exact
    near = picked(search.ann_search(queries[0], cells, centers, 5, 4))
    chunk = lambda hits: {(q, e, c) for q, _, e, c in hits}
    assert len(chunk(near) & chunk(exact)) >= 0.7 * len(exact)


def test_quantised_lists(spark, corpus, queries, folder, monkeypatch):
    df = corpus[0]
    quantiser = quantised.train(df, cells=8, parts=4)
    quantised.build_index(df, f"{folder}/lists", quantiser)
    lists = spark.read.parquet(f"{folder}/lists")
    # Every vector with a direction is listed in as many cells as it should be.
    assert lists.count() == 3 * 600 and lists.select("cell").distinct().count() == 8
    found = lambda **options: picked(quantised.quantised_search(queries[0], df, f"{folder}/lists", quantiser, **options))
    exact = brute(queries[1], corpus[1], 5)
    assert found(probed=1.0, shortlist=700) == exact
    monkeypatch.setattr(quantised, "LIST_TILE", 7)
    monkeypatch.setattr(quantised, "QUERY_TILE", 2)
    assert found(probed=1.0, shortlist=700) == exact
    chunk = lambda hits: {(q, e, c) for q, _, e, c in hits}
    assert len(chunk(found(probed=0.5)) & chunk(exact)) >= 0.8 * len(exact)
    none = df.limit(0)
    assert quantised.quantised_search(queries[0], none, f"{folder}/lists", quantised.train(none)).count() == 0
    assert quantised.quantised_search(queries[0].limit(0), df, f"{folder}/lists", quantiser).count() == 0


def test_codes_are_the_nearest_entries():
    dice = np.random.default_rng(1)
    books = [dice.normal(size=(9, 3)), dice.normal(size=(9, 2))]
    q, rest = quantised.Quantiser(np.zeros((1, 5)), books), dice.normal(size=(40, 5))
    want = [[int(np.argmin(((r[:3] - books[0]) ** 2).sum(1))), int(np.argmin(((r[3:] - books[1]) ** 2).sum(1)))] for r in rest]
    assert q.encode(rest).tolist() == want
    tables = q.tables(rest)
    assert np.allclose(tables[1][7], books[1] @ rest[7, 3:])


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_registered_search_reaches_its_recall(spark, folder):
    folder = f"/root/testdata/{folder}"
    hits = lambda name: {(r.query_id, r.episode_id, r.chunk_index) for r in registered.REGISTRY[name](spark, folder).collect()}
    exact = hits("ann_search_all_cells")
    found = len(hits("ann_search") & exact)
    assert len(exact) == 125 and found >= 0.9 * len(exact)
    assert tuple(registered._recall(Domain(spark, folder)).first()) == (125, found)


def test_queries_stand_in_files_of_their_blocks(spark, corpus):
    from earshot.sources.shared import read_block, write_blocks

    files = write_blocks(corpus[0].select("episode_id", "chunk_index"), 3, "chunk_index", "test")
    assert 2 <= len(files) <= 3 and sum(read_block(f).num_rows for f in files) == corpus[0].count()


def test_vectors_of_another_size_match_nothing(spark, corpus):
    asked = spark.createDataFrame([(1, [1.0, 2.0])], "query_id bigint, query_vector array<double>")
    assert best_matches(asked, corpus[0], Ranking(3)).frame.count() == 0
    chunks = spark.createDataFrame(
        [(1, 0, [1.0, 2.0]), (1, 1, [1.0, 2.0, 3.0]), (1, 2, [4.0]), (1, 3, [None, 2.0]), (1, 4, [2.0, 4.0])],
        "episode_id bigint, chunk_index bigint, transcript_embedding array<float>",
    )
    got = best_matches(asked, chunks, Ranking(9)).frame.orderBy("rank").collect()
    assert [(r["chunk_index"], r["score"]) for r in got] == [(0, pytest.approx(1.0)), (4, pytest.approx(1.0))]
    mixed = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0])], "query_id bigint, query_vector array<double>")
    with pytest.raises(ValueError, match="one dimension"):
        best_matches(mixed, chunks, Ranking(3))


def test_threshold_is_compared_unrounded(spark):
    """Scores just over and just under the threshold, closer than nine decimals."""
    over, under = 0.5 + 2e-11, 0.5 - 2e-11
    vectors = [[s, float(np.sqrt(1 - s * s))] for s in (over, under)]
    chunks = spark.createDataFrame(
        [(1, i, v) for i, v in enumerate(vectors)], "episode_id bigint, chunk_index bigint, transcript_embedding array<double>"
    )
    asked = spark.createDataFrame([(1, [1.0, 0.0])], "query_id bigint, query_vector array<double>")
    assert [r["chunk_index"] for r in best_matches(asked, chunks, Ranking(5, threshold=0.5)).frame.collect()] == [0]
    ranked = best_matches(asked, chunks, Ranking(5)).frame.orderBy("rank").collect()
    assert [r["chunk_index"] for r in ranked] == [0, 1]


def test_many_queries_in_one_task():
    import time

    from earshot.operators import scoring

    dice = np.random.default_rng(3)
    queries = scoring._Queries(np.arange(20_000), dice.normal(size=(20_000, 64)), np.zeros(20_000), None)
    batch = pa.RecordBatch.from_arrays(
        [pa.array(np.arange(320)), pa.array(np.arange(320)), pa.array(list(dice.normal(size=(320, 64))))],
        ["episode_id", "chunk_index", "transcript_embedding"],
    )
    started = time.perf_counter()
    best = scoring._scan(queries, Ranking(5), iter([batch]))
    assert len(best["query"]) == 100_000 and time.perf_counter() - started < 5


def test_no_queries_no_hits(spark, corpus):
    none = spark.createDataFrame([], "query_id bigint, query_vector array<double>")
    assert best_matches(none, corpus[0], Ranking(3)).frame.count() == 0


def test_coverage(corpus, tables, rows):
    got = dict(rows(search.embedding_coverage(tables[0], corpus[0])))
    assert got[0] and got[77] and set(got) == {*range(31), 77, 78}
    assert not dict(rows(search.embedding_coverage(tables[0], corpus[0].filter("episode_id <> 5"))))[5]


def test_parameters_are_checked():
    with pytest.raises(ValueError):
        Ranking(0)
    with pytest.raises(ValueError):
        Ranking(3, "dot")


def test_candidates_pass_on_when_they_are_many(spark, rows, folder, monkeypatch):
    dice = np.random.default_rng(3)
    data = [(i // 4, i % 4, dice.normal(size=8).tolist()) for i in range(400)]
    df = spark.createDataFrame(data, "episode_id bigint, chunk_index bigint, transcript_embedding array<double>")
    asked = spark.createDataFrame([(i, data[i][2]) for i in range(60)], "query_id bigint, query_vector array<double>")
    quantiser = quantised.train(df, cells=6, parts=4)
    quantised.build_index(df, f"{folder}/lists", quantiser)
    search_all = lambda: rows(quantised.quantised_search(asked, df, f"{folder}/lists", quantiser, probed=1.0))
    whole = search_all()
    monkeypatch.setattr(quantised, "MAX_FOUND", 50)
    monkeypatch.setattr(quantised, "MAX_KEPT", 20)
    assert search_all() == whole and len(whole) == 300


def test_memory_of_a_scan():
    dice = np.random.default_rng(4)
    vectors = lambda n: pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * 8, pa.int32()), pa.array(dice.normal(size=n * 8)))
    ids = np.arange(8000)
    asked = scoring._Queries(ids, scoring.matrix(vectors(8000)), np.full(8000, None), None)
    names = ["episode_id", "chunk_index", "transcript_embedding"]
    batch = pa.RecordBatch.from_arrays([pa.array(ids // 5), pa.array(ids % 5), vectors(8000)], names)
    tracemalloc.start()
    try:
        scoring._scan(asked, scoring.Ranking(5, per_episode=True), iter([batch]))
        assert tracemalloc.get_traced_memory()[1] < 120e6
    finally:
        tracemalloc.stop()


def test_scan_works_on_small_blocks_of_scores():
    dice = np.random.default_rng(9)
    vectors = lambda n: pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * 64, pa.int32()), pa.array(dice.normal(size=n * 64)))
    ids = np.arange(4000)
    asked = scoring._Queries(ids, scoring.matrix(vectors(4000)), np.full(4000, None), None)
    names = ["episode_id", "chunk_index", "transcript_embedding"]
    batch = pa.RecordBatch.from_arrays([pa.array(ids // 5), pa.array(ids % 5), vectors(4000)], names)
    for ranking in (Ranking(5, per_episode=True), Ranking(5, "l2")):
        tracemalloc.start()
        try:
            scoring._scan(asked, ranking, iter([batch]))
            assert tracemalloc.get_traced_memory()[1] < 35e6
        finally:
            tracemalloc.stop()


@pytest.mark.parametrize("order", ["any", "better later"])
@pytest.mark.parametrize(
    "ranking", [Ranking(3, threshold=0.2), Ranking(3), Ranking(4, per_episode=True), Ranking(2, per_episode=True, skip_own_episode=True), Ranking(3, "l2")]
)
def test_bounds_lose_nothing(ranking, order):
    """Many tiles, with copies, rows without direction and queries that match little."""
    rng = np.random.default_rng(9)
    vectors = rng.normal(size=(3000, DIM)).astype("float32").astype(float)
    vectors[rng.integers(3000, size=900)] = vectors[0]
    vectors[5] = vectors[2500] = 0
    asked = np.concatenate([vectors[:40], rng.normal(size=(20, DIM)), np.full((1, DIM), 1e-3)])
    if order == "better later":
        vectors = vectors[np.argsort(vectors @ asked[7])]
    episodes, chunks = np.arange(3000) // 5, np.arange(3000) % 5
    queries = scoring._Queries(np.arange(len(asked)), asked, np.arange(len(asked)) / 1.0, None)
    table = pa.table({"episode_id": episodes, "chunk_index": chunks, "transcript_embedding": list(vectors)})
    best = scoring._scan(queries, ranking, iter(table.to_batches(700)))
    got = set(zip(best["query"].tolist(), best["episode"].tolist(), best["chunk"].tolist(), best["score"].tolist()))
    q, c = (x.ravel() for x in np.indices((len(asked), len(vectors))))
    score = scoring._scores(asked[q], vectors[c], ranking.metric)
    good = ~np.isnan(score) & (score > (-9 if ranking.threshold is None else ranking.threshold))
    good &= (not ranking.skip_own_episode) | (queries.own_episode[q] != episodes[c])
    q, c, score = q[good], c[good], score[good]
    chunk = chunks[c] * (not ranking.per_episode)
    want = scoring._keep_best({"query": q, "episode": episodes[c], "chunk": chunk, "score": score}, ranking)
    assert got == set(zip(want["query"].tolist(), want["episode"].tolist(), want["chunk"].tolist(), want["score"].tolist()))


@pytest.mark.parametrize("ranking", [Ranking(3, threshold=0.2), Ranking(3, per_episode=True)])
def test_few_pairs_get_a_closer_look(monkeypatch, ranking):
    rng = np.random.default_rng(10)
    vectors, seen = rng.normal(size=(20_000, DIM)), []
    table = pa.table({"episode_id": np.arange(20_000), "chunk_index": np.zeros(20_000, int), "transcript_embedding": list(vectors)})
    ranked = scoring._candidates
    monkeypatch.setattr(
        scoring, "_candidates", lambda q, picked, v, *rest: seen.append(len(picked) * len(v)) or ranked(q, picked, v, *rest)
    )
    queries = scoring._Queries(np.arange(300), rng.normal(size=(300, DIM)), np.full(300, np.nan), None)
    best = scoring._scan(queries, ranking, iter(table.to_batches()))
    assert len(best["query"]) == 900
    assert sum(seen) < 0.05 * 300 * 20_000
