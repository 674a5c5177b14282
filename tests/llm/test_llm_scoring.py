"""Toxicity, token counts and benchmark items."""

import random
import zlib

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from earshot.llm import decontamination, token_counts, toxicity
from llm_cases import frame, odd_rows, plain_docs, stored, words

SF = "/root/testdata/sf0.01"


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def test_toxicity_of_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scored = {r.doc_id: r for r in toxicity.score_documents(docs, labels).collect()}
    assert len(scored) == docs.count() and all(0 <= r.score <= 1 for r in scored.values())
    assert all(r.held_out == held(r.doc_id) and r.predicted == (r.score >= 0.5) for r in scored.values())
    rows = duckdb.sql(f"SELECT doc_id, toxic, text FROM '{SF}/labels.parquet' JOIN '{SF}/documents.parquet' USING (doc_id)")
    own = [(scored[d], y, set((t or "").lower().split())) for d, y, t in rows.fetchall() if scored[d].held_out]
    # Some toxic rows hold nothing that another row shares.
    assert sum(r.predicted == y for r, y, _ in own) / len(own) >= 0.9
    assert sum(r.predicted for r, y, _ in own if not y) <= 1
    assert all(r.predicted for r, y, w in own if y and w & set(toxicity.SEEDS))


def test_held_out_labels_are_not_learned(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(300)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    turned = labels.withColumn("toxic", toxicity.F.when(toxicity.held_out(labels.doc_id), 1 - labels.toxic).otherwise(labels.toxic))
    scores = lambda known: sorted((r.doc_id, r.score) for r in toxicity.score_documents(docs, known).collect())
    assert scores(labels) == scores(turned)


def test_classifier_is_trained_on_posteriors(spark, monkeypatch):
    """A label model that calls nothing toxic leaves nothing toxic, whatever the labels of the trained rows say."""
    voters = toxicity.VOTERS + len(toxicity.PATTERNS)
    nothing = toxicity.LabelModel(1e-6, np.full(voters, -1), np.full((2, voters, 2), 0.5))
    monkeypatch.setattr(toxicity, "fit_label_model", lambda *_: nothing)
    docs = plain_docs(spark, [f"{'slur ' if i % 2 else ''}{words(6, i)}" for i in range(200)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, toxic int")
    assert max(r.score for r in toxicity.score_documents(docs, labels).collect()) < 0.1


def test_toxicity_of_odd_rows(spark, folder):
    docs = stored(spark, folder)
    labels = spark.createDataFrame([(8, None), (None, 1), (9, 0), (9, 1), (12, 0)], "doc_id long, toxic int")
    scored = toxicity.score_documents(docs, labels).collect()
    assert len(scored) == len(odd_rows())
    assert len({r.score for r in scored if r.doc_id in (5, 6, 7)}) == 1
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns and kept.count() <= len(odd_rows())
    nothing = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.score_documents(docs, nothing).count() == len(odd_rows())
    assert toxicity.score_documents(docs.limit(0), labels).count() == 0


def test_copies_of_a_toxic_text_leave_the_features_alone(spark):
    """Features are measured against distinct texts, however often one of them was labelled."""
    toxic = [f"slur{i // 5} " + words(8, 40 + i) for i in range(30)]
    texts = toxic + [words(9, 100 + i) for i in range(100)] + ["copied " + words(8, 7)] * 1000
    label = [1] * 30 + [0] * 100 + [1] * 1000
    docs = plain_docs(spark, texts)
    sample = spark.createDataFrame(list(enumerate(label)), "doc_id long, toxic int")
    voters = lambda rows: set((v := toxicity.mine_vocabulary(docs, sample.filter(f"doc_id < {rows}"))).hashes[v.voter >= 0].tolist())
    once, often = voters(131), voters(1130)
    assert {toxicity.word_hash(f"slur{i}") for i in range(6)} <= once
    assert often == once


def test_label_model_knows_copies_of_a_voter():
    """Rates come back, and three copies of one voter move the posterior little more than one."""
    dice = np.random.default_rng(4)
    label = (dice.random(40_000) < 0.2).astype(int)
    vote = lambda hit, false: (dice.random(len(label)) < np.where(label == 1, hit, false)).astype(int)
    first, second = vote(0.8, 0.1), vote(0.7, 0.05)
    fired = np.stack([first, first, first, second], axis=1)
    moments = np.stack([(fired * (label == c)[:, None]).T @ fired for c in (0, 1)]).astype(float)
    totals = np.array([(label == 0).sum(), (label == 1).sum()], float)
    model = toxicity.fit_tree(moments, totals)
    assert abs(model.prior - 0.2) < 0.01
    single = toxicity.fit_tree(moments[:, 2:, 2:], totals)
    for case in ([1, 1, 1, 0], [0, 0, 0, 1], [1, 1, 1, 1]):
        with_copies = model.posterior(np.array([case]))[0]
        without = single.posterior(np.array([case[2:]]))[0]
        assert abs(with_copies - without) < 0.02


def greedy(word, pieces):
    """Longest piece first, again and again; None where none fits."""
    count = at = 0
    while at < len(word):
        end = next((e for e in range(len(word), at, -1) if word[at:e] in pieces), None)
        if end is None:
            return 0
        count, at = count + 1, end
    return count


@settings(max_examples=200, deadline=None)
@given(
    st.sets(st.binary(min_size=1, max_size=5).map(lambda b: bytes(97 + x % 3 for x in b)), max_size=14),
    st.lists(st.binary(max_size=14).map(lambda b: bytes(97 + x % 4 for x in b)), max_size=12),
)
def test_longest_match_automaton(pieces, some):
    counter = token_counts.Counter(token_counts.build(sorted(pieces)))
    for word in some:
        assert counter.word(word) == greedy(word, pieces)


def test_token_counts_of_odd_rows(spark, rows):
    import public_tokenizers

    pieces = token_counts.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    known = set(pieces)
    want = []
    for row in odd_rows():
        own = (row[1] or "").encode()
        counts = [greedy(b" " + w, known) for w in own.split()]
        want.append((row[0], len(own), len(counts), sum(c or 1 for c in counts), sum(not c for c in counts)))
    got = token_counts.count_pieces(frame(spark), token_counts.build(pieces))
    assert rows(got) == sorted(want, key=repr)


def distance_in(item, text):
    """Least edit distance of the item to a substring, cell by cell."""
    column = list(range(len(item) + 1))
    best = column[-1]
    for byte in text:
        above, column[0] = column[0], 0
        for i, own in enumerate(item, 1):
            above, column[i] = column[i], min(above + (own != byte), column[i] + 1, column[i - 1] + 1)
        best = min(best, column[-1])
    return best


@settings(max_examples=150, deadline=None)
@given(st.binary(min_size=1, max_size=80).map(lambda b: bytes(97 + x % 3 for x in b)), st.binary(max_size=60).map(lambda b: bytes(97 + x % 3 for x in b)))
def test_myers_distance(item, text):
    masks = {}
    for bit, byte in enumerate(item):
        masks[byte] = masks.get(byte, 0) | 1 << bit
    assert decontamination.myers(masks, len(item), text)[0] == distance_in(item, text)


def edited(item, edits, dice):
    own = list(item)
    for _ in range(edits):
        at, kind = dice.randrange(len(own)), dice.randrange(3)
        if kind == 0:
            own[at] = dice.choice("abcdefgh ")
        elif kind == 1:
            del own[at]
        else:
            own.insert(at, dice.choice("abcdefgh "))
    return "".join(own)


def test_items_in_documents(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "SCAN_BYTES", 256)
    dice = random.Random(8)
    letters = lambda n: "".join(dice.choice("abcdefgh     ") for _ in range(n))
    items = [(i, "Item " + letters(n)) for i, n in enumerate((3, 12, 20, 60, 90, 150, 240))] + [(50, None), (51, " \n"), (52, "abc")]
    texts = [letters(100)]
    for item_id, text in items[:7]:
        for edits in (0, 1, len(text) // 10, len(text) // 10 + 3):
            texts.append(letters(dice.randint(0, 300)) + edited(text, edits, dice).upper().replace(" ", " \n") + letters(dice.randint(0, 90)))
    texts += ["", None, items[4][1], " abc ", letters(200) + items[5][1] + letters(50) + items[6][1]]
    benchmark = spark.createDataFrame(items + [items[5]], "item_id long, text string")
    want = []
    for doc_id, text in enumerate(texts):
        own, found = decontamination.normalised((text or "").encode()), []
        for item_id, item in items:
            item = decontamination.normalised((item or "").encode())
            allowed = decontamination.budget(len(item), 0.1)
            distance = distance_in(item, own) if item else 1
            if item and distance <= allowed:
                found.append((item_id, distance))
        want.append((doc_id, bool(found), sorted(i for i, _ in found), min((d for _, d in found), default=None)))
    got = decontamination.mark_contaminated(plain_docs(spark, texts).repartition(3), benchmark).collect()
    assert sorted((r.doc_id, r.contaminated, list(r.item_ids), r.n_edits) for r in got) == want
    split = decontamination.find_items(plain_docs(spark, texts), benchmark, block_bytes=100)
    assert sorted({(r.doc_id, r.item_id) for r in split.collect()}) == [(d, i) for d, _, ids, _ in want for i in ids]


def test_decontamination_of_odd_rows(spark, folder):
    docs = stored(spark, folder)
    benchmark = spark.createDataFrame([(1, words(60, 6)), (2, words(25, 9)), (3, None)], "item_id long, text string")
    kept = decontamination.drop_contaminated(docs, benchmark)
    assert kept.columns == docs.columns
    gone = [r[0] for r in odd_rows()]
    for row in kept.collect():
        gone.remove(row.doc_id)
    assert gone == [16]
    assert decontamination.drop_contaminated(docs, benchmark.limit(0)).count() == len(odd_rows())
    assert decontamination.mark_contaminated(docs.limit(0), benchmark).count() == 0


@pytest.mark.parametrize("size, edits", [(0, 0), (7, 0), (15, 0), (16, 1), (40, 4), (79, 7), (100, 10)])
def test_budget_keeps_pieces_long(size, edits):
    assert decontamination.budget(size, 0.1) == edits
