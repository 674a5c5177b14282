"""Exact, line, suffix and similarity deduplication against brute force."""

import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from earshot.llm import components, exact_dedup, jaccard_join, queries, substring_dedup, suffix_dedup
from llm_cases import classes, frame, normal, odd_rows, plain_docs, repeats, stored, words

by_text = lambda rows: sorted(rows, key=repr)


def test_exact_groups(spark, rows):
    cases = [(r[0], r[1]) for r in odd_rows()]
    groups = {}
    for doc_id, text in cases:
        groups.setdefault(normal(text), []).append(doc_id)
    want = []
    for doc_id, text in cases:
        own = groups[normal(text)]
        keep = min((i for i in own if i is not None), default=None)
        want.append((doc_id, keep, len(own), hashlib.sha256(normal(text).encode()).hexdigest()))
    got = exact_dedup.exact_groups(frame(spark))
    assert rows(got, "doc_id", "keep_id", "group_size", "text_sha256") == by_text(want)
    kept = got.filter("kept").collect()
    assert len(kept) == len(groups) and all(r.doc_id == r.keep_id for r in kept)


def test_frequent_texts_are_split_off(spark):
    texts = ["common"] * 400 + ["often"] * 60 + [f"text {i}" for i in range(300)]
    docs = plain_docs(spark, texts)
    slim = docs.selectExpr("xxhash64(text) AS _print")
    assert exact_dedup.frequent(slim, heavy=2, tracked=16).count() == 2
    kept = exact_dedup.exact_groups(docs, heavy=2, tracked=16).filter("kept").collect()
    assert sorted((r.keep_id, r.group_size) for r in kept)[:2] == [(0, 400), (400, 60)]
    assert len(kept) == 302


def test_drop_copies_keeps_columns(spark, folder):
    docs = stored(spark, folder)
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns
    texts = [normal(r.text) for r in kept.collect()]
    assert len(texts) == len(set(texts)) == len({normal(r[1]) for r in odd_rows()})


def removed_units(cases, cut, min_run):
    """Per row the removed spans and the rest, unit by unit in rank order."""
    seen, out = set(), {}
    for i in sorted(range(len(cases)), key=lambda i: (cases[i][0] is None, cases[i][0] or 0)):
        pieces, start = [], 0
        for piece in cut(cases[i][1] or ""):
            key = b" ".join(piece.encode().lower().split())
            if key:
                words = max(len(key.split()), len(key.decode()) // 8)
                pieces.append([start, start + len(piece), words, key in seen])
                seen.add(key)
            start += len(piece)
        spans, run = [], []
        for piece in [*pieces, [0, 0, 0, False]]:
            if piece[3]:
                run.append(piece)
                continue
            if sum(p[2] for p in run) >= min_run:
                spans += [(p[0], p[1]) for p in run]
            run = []
        text = cases[i][1] or ""
        gone = {at for s, e in spans for at in range(s, e)}
        out[i] = (cases[i][0], spans, "".join(c for at, c in enumerate(text) if at not in gone))
    return [out[i] for i in range(len(cases))]


def lines_of(text):
    parts = text.split("\n")
    return [p + "\n" for p in parts[:-1]] + parts[-1:]


def sentences_of(text):
    out, piece, ended = [], "", False
    for c in text:
        if ended and not (c in " \t\n\x0b\f\r" or (c in ".!?。！？" and piece[-1] in ".!?。！？")):
            out.append(piece)
            piece, ended = "", False
        piece += c
        ended = ended or c in "\n.!?。！？"
    return [*out, piece]


SENTENCE_CASES = [
    (0, "One two three four five six. Seven eight nine ten!  Eleven twelve thirteen fourteen fifteen.\n\nSixteen seventeen? Own end"),
    (1, "Begin. one TWO three four five six. seven eight nine ten!\nEleven twelve thirteen fourteen fifteen. Sixteen seventeen? New end."),
    (2, "One two three four five six. Another. Seven eight nine ten! Stop... Sixteen seventeen? 3.14 it is"),
    (3, "字字字字字字字字字字字字字字字字字字字字字字字字字字字字字字字字字字字字字字字字。" * 2 + "词。" + "文" * 170 + "！尾"),
    (4, "头。" + "文" * 170 + "！ 词。"), (5, "..!! \n ?"), (6, "..!! \n ?"), (7, None), (8, ""), (8, "Stop... Begin."), (None, "New end."),
]


@pytest.mark.parametrize("min_run", [0, 3, 20])
def test_repeated_sentences(spark, folder, min_run):
    cases = [(r[0], r[1]) for r in odd_rows()] + SENTENCE_CASES
    docs = stored(spark, folder, [(*c, *odd_rows()[0][2:]) for c in cases])
    got = substring_dedup.remove_repeats(docs, min_run=min_run).collect()
    found = by_text((r.doc_id, [(s.start, s.end) for s in r.removed], r.text) for r in got)
    assert found == by_text(removed_units(cases, sentences_of, min_run))


def test_repeated_lines(spark):
    cases = [(r[0], r[1]) for r in odd_rows()]
    for min_run in (0, 20):
        got = substring_dedup.remove_repeats(frame(spark), substring_dedup.LINES, min_run).collect()
        found = by_text((r.doc_id, [(s.start, s.end) for s in r.removed], r.text) for r in got)
        assert found == by_text(removed_units(cases, lines_of, min_run))


def test_short_lines_and_lines_without_spaces(spark, folder):
    spaceless = "字" * 60
    texts = [f"dans pas.\n{spaceless}\n\nown {i}" for i in range(3)]
    plain_docs(spark, texts).write.parquet(f"{folder}/documents.parquet")
    got = queries.REGISTRY["op1_substring_dedup_every_line"](spark, folder).collect()
    spans = "0-10,10-71"
    assert sorted((r.doc_id, r.n_removed, r.removed_spans) for r in got) == [(0, 0, ""), (1, 2, spans), (2, 2, spans)]
    assert queries.ORACLE["op1_substring_dedup_every_line"] != queries.ORACLE["op1_substring_dedup"]


def test_a_sentence_of_most_documents_is_settled_where_it_is_read(spark):
    texts = [f"This sentence stands in all of the documents. Number {i} is its own. So does this one too." for i in range(300)]
    got = substring_dedup.remove_repeats(plain_docs(spark, texts), min_run=8).collect()
    assert {(r.doc_id == 0, len(r.removed)) for r in got} == {(True, 0), (False, 1)}


def test_paragraphs_are_units_of_another_pattern(spark):
    block = "first line of a paragraph\nsecond line of it"
    docs = plain_docs(spark, [block + "\n\nown words here", "x\n\n" + block])
    got = substring_dedup.remove_repeats(docs, substring_dedup.PARAGRAPHS, 5).collect()
    assert {r.doc_id: r.text for r in got} == {0: block + "\n\nown words here", 1: "x\n\n"}


def suffix_result(docs):
    return [(r.doc_id, len(r.spans), bytes(r.kept), sum(s.end - s.start for s in r.spans)) for r in suffix_dedup.remove_repeats(docs).collect()]


def test_suffix_dedup_of_odd_rows(spark):
    cases = [(r[0], r[1]) for r in odd_rows()]
    want = [(d, runs, left, gone) for d, _, gone, runs, left in repeats(cases) if gone]
    assert by_text(suffix_result(frame(spark))) == by_text(want)


@pytest.mark.parametrize("seed", [1, 2])
def test_suffix_dedup_of_shuffled_passages(spark, monkeypatch, seed):
    """Passages of about the length of a string, periodic stretches, zero bytes, texts longer than a slice."""
    monkeypatch.setattr(suffix_dedup, "SLICE_BYTES", 700)
    monkeypatch.setattr(suffix_dedup, "RUN_SEGMENTS", 40)
    dice = random.Random(seed)
    passages = [words(dice.randint(3, 30), s) for s in range(12)] + ["ab" * 150, "\0" * 130, "é" * 90, "abc" * 40]
    texts = []
    for _ in range(60):
        parts = [dice.choice(passages)[dice.randint(0, 9) :] for _ in range(dice.randint(1, 9))]
        texts.append(dice.choice(["", " ", "\n"]).join(parts))
    want = [(d, runs, left, gone) for d, _, gone, runs, left in repeats(list(enumerate(texts))) if gone]
    assert by_text(suffix_result(plain_docs(spark, texts).repartition(5))) == by_text(want)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.binary(max_size=6).map(lambda b: bytes(x % 3 for x in b)), max_size=12), min_size=1, max_size=7))
def test_loser_tree(lists):
    runs = []
    for number, own in enumerate(lists):
        ranks = [(number, i, 0) for i in range(len(own))]
        runs.append(suffix_dedup.sorted_runs(own, ranks)[0])
    runs = [suffix_dedup.decode_run(*suffix_dedup.encode_run(r)) for r in runs]
    got = list(suffix_dedup.merged(runs))
    assert [(s, r) for s, _, r in got] == sorted((s, tuple(r)) for run in runs for s, r in zip(run.strings, run.ranks))
    for (a, _, _), (b, shared, _) in zip(got, got[1:]):
        assert shared == suffix_dedup.common_prefix(a, b, 0)
        assert a[:shared] == b[:shared] and (len(a) == shared or len(b) == shared or a[shared] != b[shared])


def test_similarity_classes_of_odd_rows(spark):
    cases = [(r[0], r[1]) for r in odd_rows()]
    got = jaccard_join.similarity_classes(frame(spark)).collect()
    assert by_text((r.doc_id, r.n_shingles, r.component_id) for r in got) == by_text(classes(cases))


@pytest.mark.parametrize("seed", [1, 2])
def test_similarity_classes_of_near_copies(spark, seed):
    """Chains of copies of copies, sets around the bound, a passage all have in common."""
    dice = random.Random(seed)
    texts = []
    for s in range(6):
        own = (words(dice.randint(8, 60), s) + " " + words(12, 99)).split()
        texts.append(" ".join(own))
        for _ in range(12):
            copy = texts[-1 if dice.random() < 0.5 else dice.randrange(len(texts))].split()
            for _ in range(dice.randint(0, 2)):
                copy[dice.randrange(len(copy))] = f"new{dice.randint(0, 9)}"
            texts.append(" ".join(copy).upper() if dice.random() < 0.2 else "  ".join(copy))
    got = jaccard_join.similarity_classes(plain_docs(spark, texts).repartition(4)).collect()
    assert by_text((r.doc_id, r.n_shingles, r.component_id) for r in got) == by_text(classes(list(enumerate(texts))))


def test_one_per_class(spark, folder):
    docs = stored(spark, folder)
    kept = jaccard_join.one_per_class(docs)
    assert kept.columns == docs.columns
    cases = [(r[0], r[1]) for r in odd_rows()]
    alone = sum(1 for _, n, _ in classes(cases) if n == 0)
    linked = {c for _, n, c in classes(cases) if n}
    assert kept.count() == alone + len(linked)


@pytest.mark.parametrize("block", [500_000, 9])
def test_components_of_chains_and_stars(spark, monkeypatch, block):
    monkeypatch.setattr(components, "BLOCK_LINKS", block)
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(7, i) for i in range(200, 260)] + [(255, 3)]
    got = components.components(spark.createDataFrame(chain + star + [(9, 9)], "a long, b long")).collect()
    assert {r.id: r.label for r in got} == {**{i: 100 for i in range(100, 161)}, **{i: 3 for i in [3, 7, *range(200, 260)]}}


def test_no_rows(spark, folder):
    empty = stored(spark, folder, [])
    assert exact_dedup.exact_groups(empty).count() == 0
    assert exact_dedup.drop_copies(empty).count() == 0
    assert substring_dedup.remove_repeats(empty).count() == 0
    assert suffix_dedup.remove_repeats(empty).count() == 0
    assert jaccard_join.similarity_classes(empty).count() == 0
    assert jaccard_join.one_per_class(empty).count() == 0
