"""Line dedup, spelling variants and tokenizer alignment against plain versions."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from llm_cases import LINE, LOWER, SCHEMA, frame, odd_rows, plain_docs, stored, words

from earshot.llm import alignment, line_dedup, spelling

LONG = "This line is long enough to count, and other documents hold it as well."


def line_rows():
    rows = [(r[0], r[1]) for r in odd_rows()]
    rows += [(100 + i, f"start {i}\n  {LONG}\t\nend\n{LONG.upper()}") for i in range(6)]
    rows += [(200, f"{LONG}\n"), (200, f"\n{LONG}\n{LONG}"), (None, LONG), (300, "é" * 45), (301, "é" * 45 + "\n")]
    rows += [(302, "é" * 45), (303, "x\n" + "é" * 45), (304, "é" * 45), (305, LONG[:38]), (306, "\r" + LONG[:38])]
    rows += [(400 + i, "z" * 60) for i in range(4)]
    return [(*r, *odd_rows()[0][2:]) for r in rows]


def dropped_lines(rows, min_chars=40, min_docs=5):
    key = lambda line: line.strip(" \t\n\x0b\f\r").translate(LOWER)
    holders = defaultdict(set)
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if doc_id is not None and len(key(line)) >= min_chars:
                holders[key(line)].add(doc_id)
    last = {k: max(ids) for k, ids in holders.items() if len(ids) >= min_docs}
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if doc_id is None or last.get(key(x), doc_id) == doc_id]
        out.append((doc_id, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("batches", [1, 2, 5])
def test_lines_equal_the_plain_version_whatever_the_batches(spark, folder, rows, batches):
    given = line_rows()
    got = line_dedup.drop_repeated_lines(stored(spark, folder, given), batches=batches)
    want = dropped_lines([r[:2] for r in given])
    assert rows(got) == want
    assert sum(r[3] for r in want) >= 12


def test_lines_of_tables_without_rows_or_text(spark, rows):
    assert rows(line_dedup.drop_repeated_lines(frame(spark, odd_rows()).limit(0))) == []
    assert rows(line_dedup.drop_repeated_lines(plain_docs(spark, [None, ""]))) == [(0, "", 1, 0), (1, "", 1, 0)]


def test_runs_hold_a_digest_once_and_compact(spark, rows):
    runs = line_dedup.LineRuns(spark, 3)
    for batch in range(5):
        lines = spark.range(batch * 10, batch * 10 + 40).selectExpr("unhex(md5(CAST(id AS STRING))) AS digest", f"{batch}L AS doc_id")
        runs.add(lines.unionByName(lines))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    held = [r.digest for name in runs.runs() for r in runs._run(name).collect()]
    assert len(held) == len(set(held)) == 80
    counted = {r.n_docs: r.n for r in runs.frequent(1).groupBy("n_docs").agg({"digest": "count"}).toDF("n_docs", "n").collect()}
    assert counted == {1: 20, 2: 20, 3: 20, 4: 20}
    assert {r.last_doc for r in runs.frequent(4).collect()} == {3, 4}
    join = runs._run(runs.runs()[-1]).groupBy("digest").count()
    assert "Exchange" not in join._jdf.queryExecution().executedPlan().toString()
    runs.close()


def test_a_line_of_most_documents_is_settled_where_it_is_read(spark, rows):
    given = [(i, f"{LONG}\nown line {i} of the document that is long enough") for i in range(400)]
    got = line_dedup.drop_repeated_lines(spark.createDataFrame(given, "doc_id long, text string"))
    assert rows(got) == dropped_lines(given)


def spelled(rows, slips=None):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if slips and h % slips == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += len(run) >= 5
    n = {w: c for w, c in counts.items() if c >= 3}
    near = {w: {v for v in n if one_edit(w, v)} for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        if best and n[best] >= 2 * n[w]:
            form[w] = best
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None))
    return sorted(out, key=repr)


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(a == b[:i] + b[i + 1 :] for i in range(len(b)))


def spelling_rows():
    rows = [(r[0], r[1]) for r in odd_rows()]
    base = ["banana", "bananas", "Bananna", "aaaaa", "aaaaaa", "baaaa", "élève", "eleve", "élevé", "straße", "strase", "times×x"]
    for i, word in enumerate(base):
        rows += [(500 + i, f"{word} ") for _ in range(3)] + [(600 + i, f"{word} " * (40 if i % 3 == 1 else 9 * (i % 3)))]
    rows += [(700, " ".join(f"w{chr(97 + i % 26)}rd{chr(97 + i // 26)}s" for i in range(300))) for _ in range(3)]
    return [(*r, *odd_rows()[0][2:]) for r in rows]


@pytest.mark.parametrize("slips", [None, 3])
def test_spelling_equals_comparing_all_words(spark, folder, rows, slips):
    given = spelling_rows()
    got = spelling.spelling_variants(stored(spark, folder, given), slips=slips)
    want = spelled([r[:2] for r in given], slips)
    assert rows(got) == want
    assert sum(r[1] is not None for r in want) >= 3


def test_spelling_lists_are_cut_without_losing_pairs(spark, rows, monkeypatch):
    given = [r[:2] for r in spelling_rows()]
    monkeypatch.setattr(spelling, "LIST_BLOCK", 3)
    docs = spark.createDataFrame(given, "doc_id long, text string")
    words = spelling.word_counts(docs)
    pairs = spelling.near_words(words, dictionary=3)
    n = {r.word: r.n for r in words.collect()}
    assert rows(pairs) == sorted(((a, n[a], b, n[b]) for a in n for b in n if a < b and one_edit(a, b)), key=repr)


def test_an_edit_spoils_no_more_grams_than_the_bound(spark):
    often = {"an", "na", "ana", "nan", "\x02b", "ban", "aa", "aaa", "aaaa"}
    for word in ["banana", "aaaaa", "bananas", "cabana", "aabaa"]:
        own, spoiled = spelling.decompose(word, often)
        edits = {word[:i] + c + word[j:] for i in range(len(word) + 1) for c in ("", "a", "n", "x") for j in (i, i + 1)}
        for other in edits:
            both = Counter(own) & Counter(spelling.decompose(other, often)[0])
            assert sum(both.values()) >= len(own) - spoiled


def test_spelling_of_nothing(spark, rows):
    assert rows(spelling.spelling_variants(plain_docs(spark, [None, "", "one two"]))) == []
    assert rows(spelling.spelling_variants(plain_docs(spark, ["x"]).limit(0))) == []
    with pytest.raises(ValueError):
        spelling.spelling_variants(plain_docs(spark, ["x"]), min_chars=3)


@pytest.fixture(scope="module")
def vocabularies():
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


ODD_TEXTS = [
    None, "", " ", "\n\n", "Hello, world!  Twice  spaced.\n\tTabs", "<|endoftext|> and </s> <s> <unk>", "▁under▁score",
    "naïve café – “quoted” … 中文 日本語 🙂🙃", "a\x00b", "​﻿zero", "x" * 3000, "é combining", "don't I'll 12345",
    words(900, 3), "<0x41> literal", "\r\nline\x0bends\x0c",
]


def aligned_plainly(given, paths):
    import sentencepiece
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(paths[0]), sentencepiece.SentencePieceProcessor(model_file=paths[1])
    a.encode_special_tokens = True

    def b_bytes(i):
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()

    def a_bytes(i):
        return bytes(alignment._BYTE_OF[c] for c in a.id_to_token(i))

    per, corpus = [], Counter()
    for text in given:
        a_ids, b_ids = a.encode(" " + (text or ""), add_special_tokens=False).ids, b.encode(text or "")
        whole = (" " + (text or "")).encode()
        if not text or b"".join(map(a_bytes, a_ids)) != whole or b"".join(map(b_bytes, b_ids)) != whole:
            per.append(None)
            continue
        ends, at = {}, 0
        for k, i in enumerate(a_ids):
            at += len(a_bytes(i))
            ends[at] = k
        at = a_from = b_from = 0
        groups = []
        for k, i in enumerate(b_ids):
            at += len(b_bytes(i))
            if at in ends:
                groups.append((a_ids[a_from : ends[at] + 1], b_ids[b_from : k + 1]))
                a_from, b_from = ends[at] + 1, k + 1
        per.append((a_ids, b_ids, groups))
        corpus.update((x[-1], y[-1]) for x, y in groups)
    most = defaultdict(int)
    for (_, y), n in corpus.items():
        most[y] = max(most[y], n)
    out = []
    for doc_id, one in enumerate(per):
        if one is None:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        links = [(x[-1], y[-1]) for x, y in one[2]]
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in one[2])
        best = sum(corpus[p] == most[p[1]] for p in links)
        digest = hashlib.sha256(text.encode()).hexdigest()
        out.append((doc_id, len(one[0]), len(one[1]), len(links), len(links), best, sum(corpus[p] for p in links), digest))
    return sorted(out, key=repr)


def test_alignment_equals_the_plain_version(spark, rows, vocabularies, monkeypatch):
    got = alignment.align(plain_docs(spark, ODD_TEXTS).repartition(3), *vocabularies).drop("pairs", "times")
    want = aligned_plainly(ODD_TEXTS, vocabularies)
    assert rows(got) == want
    assert sum(r[1] == 0 for r in want) in range(3, 8)


def test_alignment_of_odd_rows_keeps_each(spark, folder, vocabularies):
    given = stored(spark, folder)
    got = alignment.align(given, *vocabularies).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in got) == sorted((r[0] is None, r[0] or 0) for r in odd_rows())
    assert len({(r.n_a, r.groups_sha256) for r in got if r.doc_id == 17}) == 1
    assert alignment.align(given.limit(0), *vocabularies).count() == 0
    assert LINE and SCHEMA


def test_lanes_do_not_change_what_ends_together():
    rng = np.random.default_rng(1)
    for size in (1, 7, 400):
        a = np.unique(np.append(rng.integers(1, 1000, size), 1000))
        b = np.unique(np.append(rng.integers(1, 1000, size), 1000))
        for lane in (1, 13, 1000):
            stops = np.unique(np.append(np.arange(lane, 1000, lane), 1000))
            met_a, met_b = alignment.common_ends(a, b, stops)
            assert a[met_a].tolist() == b[met_b].tolist() == sorted(set(a.tolist()) & set(b.tolist()))


def test_both_byte_level_readers_agree(vocabularies):
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(vocabularies[0])
    slow.encode_special_tokens = True
    fast = alignment.Aligner(*vocabularies).a
    texts = [f" a{chr(c)}b 1{chr(c)}2 {chr(c)}{chr(c)}'{chr(c)}s" for c in [*range(0x3000), *range(0xF900, 0x10000), *range(0x1F000, 0x1FB00)]]
    for text, one in zip(texts, slow.encode_batch_fast(texts, add_special_tokens=False)):
        assert fast.encode_ordinary(text) == one.ids
