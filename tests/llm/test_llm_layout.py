"""Archives, packing, sharding and the pipeline."""

import glob
import gzip
import hashlib
import math
import zlib
from base64 import b32encode

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from earshot.llm import jaccard_join, packing, sharding, toxicity, warc
from earshot.llm.common import listed_rows, numbered, row_lists, settled, with_listed
from llm_cases import classes, frame, normal, odd_rows, stored, words

PAGES = [
    (1, "http://a/1", "<p>one</p>"),
    (2, "http://a/2", "<p>one</p>"),
    (3, None, "<p>one</p>"),
    (4, "http://a/%0A\r\nx", ""),
    (5, "http://a/5", None),
    (6, "http://a/6", "é\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n" + "x" * 300_000),
    (7, "http://a/7", "last"),
    (7, "http://a/7", "last"),
    (None, "http://a/n", "nobody"),
    (None, "http://a/m", "last"),
]


def pages(spark, rows=PAGES):
    own = spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, offset string, _row string")
    return own.repartition(3)


def wanted(rows, least=0):
    out = []
    for at, (page_id, _, html) in enumerate(rows):
        payload = (html or "").encode()
        same = [i for i, r in enumerate(rows) if (r[2] or "") == (html or "")]
        best = max(rows[i][0] if rows[i][0] is not None else -1 for i in same)
        first = len(payload) < least or (page_id is not None and page_id == best) or (best == -1)
        out.append((page_id, len(payload), b32encode(hashlib.sha1(payload).digest()).decode(), first, None if first else best))
    return out


def test_archives_round_trip(spark, folder):
    index = warc.write_archives(pages(spark), f"{folder}/warc")
    found = warc.read_records(index, f"{folder}/warc").collect()
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type == "response", r.refers_to) for r in found]
    want = wanted(PAGES)
    # Of the two rows that are alike in everything one is the response.
    want[7] = (7, 4, want[7][2], False, 7)
    assert sorted(got, key=repr) == sorted(want, key=repr)
    payloads = {r.page_id: r.payload for r in found if r.record_type == "response" and r.page_id is not None}
    assert payloads == {i: (h or "").encode() for i, _, h in PAGES if i in (3, 5, 6, 7)}
    assert sorted((r.page_id or 0, r.url or "") for r in found) == sorted((p or 0, u or "") for p, u, _ in PAGES)


def test_index_names_the_bytes_of_each_record(spark, folder):
    index = warc.write_archives(pages(spark), f"{folder}/warc").collect()
    for row in index:
        data = open(f"{folder}/warc/{row.file}", "rb").read()
        record = warc.decode_record(data[row.offset : row.offset + row.length])
        assert (record.page_id, record.url, record.record_type) == (row.page_id, row.url, row.record_type)
    size = sum(len(open(f, "rb").read()) for f in glob.glob(f"{folder}/warc/*.warc.gz"))
    assert size == sum(r.length for r in index)


def test_some_records_only(spark, folder):
    index = warc.write_archives(pages(spark), f"{folder}/warc", min_bytes=5)
    picked = warc.read_records(index.filter("page_id IN (2, 7)"), f"{folder}/warc").collect()
    assert sorted((r.page_id, r.record_type, r.refers_to) for r in picked) == [
        (2, "revisit", 3), (7, "response", None), (7, "response", None),
    ]


def test_neighbouring_ranges_are_one_read():
    ranges = [("a", 0, 10), ("a", 10, 10), ("a", 20 + warc.GAP + 1, 5), ("b", 0, 5), ("b", 5, warc.READ), ("b", warc.READ + 5, 1)]
    reads = [(r[0], r[1], r[2], r[3], r[4]) for r in warc._coalesced(ranges)]
    assert reads == [
        ("a", 0, 20, 0, 2), ("a", 20 + warc.GAP + 1, 25 + warc.GAP + 1, 2, 3),
        ("b", 0, 5, 3, 4), ("b", 5, warc.READ + 5, 4, 5), ("b", warc.READ + 5, warc.READ + 6, 5, 6),
    ]


def test_damaged_record_is_an_error():
    record = warc.encode_record(1, "u", b"payload", "response", None)
    plain = gzip.decompress(record)
    with pytest.raises(ValueError):
        warc.decode_record(gzip.compress(plain.replace(b"payload", b"pAyload")))
    with pytest.raises(ValueError):
        warc.decode_record(gzip.compress(plain[:-1]))
    with pytest.raises((EOFError, gzip.BadGzipFile)):
        warc.decode_record(record[:-1])


def test_no_pages(spark, folder):
    index = warc.write_archives(pages(spark, []), f"{folder}/warc")
    assert index.count() == 0 and warc.read_records(index, f"{folder}/warc").count() == 0


def tokenizer_path():
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def test_packing_of_odd_rows(spark):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(tokenizer_path())
    rows = [(r[0], r[1]) for r in odd_rows()] + [
        (40, "<|endoftext|> and <|startoftext|>x don't we've 123 ÀÉ́   ΣΑΣ. ΟΔΟΣ \x1cİ"), (41, "na" * 3000), (42, "\x85\x1f 　"),
    ]
    docs = frame(spark, [(*r, "en", None, 1, "r", "s", "d", "t", "l", "k", "o") for r in rows])
    got = packing.pack(docs, tokenizer_path()).collect()
    want = sorted(tuple(whole.encode(t or "", add_special_tokens=False).ids) + (2,) for _, t in rows)
    pieces = {}
    for r in got:
        assert r.length == len(r.payload) // 4 <= 4096
        pieces.setdefault((r.doc_id, r.doc_tokens, r.start), []).append(tuple(np.frombuffer(r.payload, "<u4").tolist()))
    texts = []
    for (doc_id, total, start), own in pieces.items():
        if start == 0:
            for nth, first in enumerate(sorted(own)):
                ids = first
                while len(ids) < total:
                    ids += sorted(pieces[doc_id, total, len(ids)])[nth]
                texts.append(ids)
    assert sorted(texts) == want
    for number in {r.sequence_id for r in got}:
        own = sorted((r for r in got if r.sequence_id == number), key=lambda r: r.offset)
        assert [r.offset for r in own] == [sum(x.length for x in own[:i]) for i in range(len(own))]
        assert sum(r.length for r in own) <= 4096
    assert packing.pack(docs.limit(0), tokenizer_path()).count() == 0


def test_windows_are_near_equal():
    dice = np.random.default_rng(3)
    for n, most in ((1, 4095), (7, 4095), (300, 3000), (800, 900)):
        sizes = dice.integers(1, most + 1, n)
        window = packing.spread_over_windows(sizes, 4096)
        sums = np.bincount(window, sizes)
        assert sums.max() <= 4096 and (sums > 0).all()
        assert len(sums) <= math.ceil(sizes.sum() / 4096) * 1.12 + 1
        if most < 1000:
            assert sums.max() - sums.min() < 0.1 * 4096
    window, largest = packing.differencing(np.array([8, 7, 6, 5, 4]), 2)
    assert largest == 16 and sorted(np.bincount(window, [8, 7, 6, 5, 4]).tolist()) == [14, 16]


def test_shards(spark, folder):
    docs = frame(spark)
    got = sharding.shard_documents(docs, shards=7, path=f"{folder}/shards")
    assert got.columns[:2] == ["doc_id", "text"] and "odd.name" in got.columns and got.columns.count("shard") == 1
    rows = got.collect()
    assert sorted(((r.doc_id, r.text) for r in rows), key=repr) == sorted(((r[0], r[1]) for r in odd_rows()), key=repr)
    assert all(r["size"] == len((r.text or "").encode()) + 8 for r in rows)
    by_shard = {}
    for r in rows:
        by_shard.setdefault(r.shard, []).append(r.slot)
    counts = [len(by_shard.get(s, [])) for s in range(7)]
    assert max(counts) - min(counts) <= 1
    assert all(sorted(slots) == list(range(len(slots))) for slots in by_shard.values())
    place = lambda frame_: sorted(((r.doc_id, r.text, r.shard, r.slot) for r in frame_.collect()), key=repr)
    again = sharding.shard_documents(docs.repartition(5), shards=7)
    other = sharding.shard_documents(docs, shards=7, seed=18)
    assert place(again) == place(got) != place(other)
    assert sharding.shard_documents(docs.limit(0)).count() == 0


def test_shuffle_is_uniform(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("same text").alias("text"))
    shards = [r.shard for r in sharding.shard_documents(docs, shards=8, bucket_bytes=4096).orderBy("doc_id").collect()]
    table = np.zeros((4, 8))
    for i, s in enumerate(shards):
        table[i // 1000, s] += 1
    assert np.abs(table - 125).max() < 45


def test_pipeline_stages_follow_brute_force(spark, folder):
    toxic = "what an idiot and a moron, worthless trash " + words(80, 31)
    item = words(30, 1077)
    rows = [(r[0], r[1]) for r in odd_rows()] + [(60 + i, toxic + f" {i}") for i in range(30)]
    rows += [(100, words(50, 41) + " " + item.upper() + " " + words(20, 42)), (101, words(60, 43))] + [(102 + i, words(40, 50 + i)) for i in range(90)]
    extra = ("en", None, 1, "r", "s", "d", "t", "l", "k", "o")
    frame(spark, [(*r, *extra) for r in rows]).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 1, 1) for i in range(60, 90)] + [(102 + i, 1, 0) for i in range(90)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, left = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, folder).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        left[name] = [(r.doc_id, r.text) for r in docs.collect()] if name != "packing" else docs.collect()
        assert name == "packing" or docs.columns == columns
    assert sorted(left["toxicity"], key=repr) == sorted((r for r in rows if "idiot" not in (r[1] or "")), key=repr)
    texts = {normal(t) for _, t in left["toxicity"]}
    assert sorted(normal(t) for _, t in left["exact_dedup"]) == sorted(texts)
    named = classes(left["exact_dedup"])
    assert len(left["jaccard_join"]) == sum(n == 0 for _, n, _ in named) + len({c for _, n, c in named if n})
    assert sorted(left["decontamination"], key=repr) == sorted((r for r in left["jaccard_join"] if r[0] != 100), key=repr)
    assert {(r.doc_id, r.doc_tokens) for r in left["packing"] if r.start == 0 and r.doc_id == 101} and len({r.doc_id for r in left["packing"]}) == len({d for d, _ in left["decontamination"]})
    again = corpus_pipeline.run(spark, folder)
    key = lambda r: (r.doc_id, r.start, zlib.crc32(r.ids), r.sequence_id, r.offset)
    assert sorted(map(key, again.collect()), key=repr) == sorted(map(key, left["packing"]), key=repr)


def test_pipeline_without_documents(spark, folder):
    empty = stored(spark, folder, [])
    empty.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0


def test_rows_are_picked_where_they_are_scanned(spark, folder):
    docs = stored(spark, folder)
    every = numbered(docs).collect()
    some = [r._row for r in every if r._row % 2 == 0 or r.doc_id == 17]
    assert len({r >> 33 for r in some}) > 1
    path = row_lists(spark.createDataFrame([(r, f"v{r}") for r in some], "_row long, note string"))
    key = lambda rows: sorted((repr(tuple(r)) for r in rows))
    whole = key(docs.collect())
    kept, left = (key(listed_rows(docs, path, keep).collect()) for keep in (True, False))
    assert sorted(kept + left) == whole and len(kept) == len(some)
    assert listed_rows(docs, path).schema == docs.schema
    noted = with_listed(numbered(docs), path, "note", "string").collect()
    assert sorted((r._row, r.note) for r in noted) == sorted((r, f"v{r}") for r in some)
    none = row_lists(spark.createDataFrame([], "_row long"))
    assert listed_rows(docs, none).count() == 0 and listed_rows(docs, none, False).count() == len(whole)
    plan = listed_rows(docs, path)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_only_files_keep_their_rows_in_place(spark, folder):
    docs = stored(spark, folder)
    assert settled(docs) is docs
    picked = docs.filter("doc_id > 3").select("doc_id")
    assert settled(picked) is picked
    assert settled(docs.distinct()) is not docs and settled(spark.range(3)).count() == 3


def test_packing_remembers_chunks_that_come_again():
    tokenizer = packing.ChunkTokenizer(tokenizer_path(), 2)
    once = " ".join(f"word{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}{'uvwxyz'[i // 100]}" for i in range(600)).encode()
    first = list(tokenizer.batch([once]))
    # Some marks may stand at one place, so a few are kept at once.
    assert len(tokenizer.known) < 10
    assert list(tokenizer.batch([once])) == first and len(tokenizer.known) == 600
    assert list(tokenizer.batch([once, once])) == first * 2


def test_packing_forgets_the_oldest_generation(monkeypatch):
    monkeypatch.setattr(packing, "MEMORY", 5)
    known = packing._Known(lambda part: part * 2)
    for i in range(100):
        assert known[b"%d" % (i % 13)] == b"%d" % (i % 13) * 2
        assert len(known) <= 5 and len(known.before) <= 5


def test_packing_hands_words_before_any_marks_to_the_pairs_alone(monkeypatch):
    """The whole tokenizer, several times as slow, sees only the marks, and those once for all words of a batch."""
    from tokenizers import Tokenizer

    handed, plain = [], packing._plain_ids
    monkeypatch.setattr(packing, "_plain_ids", lambda tokenizer, part: handed.append(part) or plain(tokenizer, part))
    marks = ["", "***", "###", "%%$", "'", '."', "_", "<|", "!"]
    words = [a + b + c for a in "aÉßzÿ" for b in "IkðØ" for c in ("na", "çon", "TH")]
    text = " ".join(word + mark for word in words for mark in marks)
    got = list(packing.ChunkTokenizer(tokenizer_path(), 2).batch([text.encode(), text.lower().encode()]))
    whole = Tokenizer.from_file(tokenizer_path())
    ids = np.array(whole.encode(text, add_special_tokens=False).ids + [2], "<u4").tobytes()
    assert got == [ids, ids]
    assert sorted(handed) == sorted(m.encode() for m in marks if m)


def test_packing_minds_a_tokenizers_own_tokens(folder):
    import json

    from tokenizers import Tokenizer

    with open(tokenizer_path()) as file:
        steps = json.load(file)
    kind = {"single_word": False, "lstrip": False, "rstrip": False, "normalized": False, "special": True}
    steps["added_tokens"].append({"id": 49_408, "content": "do?", **kind})
    path = f"{folder}/own_tokens.json"
    with open(path, "w") as file:
        json.dump(steps, file)
    text = "What to do?? Undo? do ?"
    whole = Tokenizer.from_file(path)
    ids = whole.encode(text, add_special_tokens=False).ids
    assert ids.count(whole.token_to_id("do?")) == 2
    assert list(packing.ChunkTokenizer(path, 2).batch([text.encode()])) == [np.array(ids + [2], "<u4").tobytes()]


def test_packing_sends_short_batches():
    import pyarrow as pa

    texts = [f"some text number {i} ".encode() * 5000 for i in range(40)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(40)), pa.array([t.decode() for t in texts])], ["doc_id", "text"])
    tokenizer = packing.ChunkTokenizer(tokenizer_path(), 2)
    sent = list(packing._pieces(batch, tokenizer, 4096, bytes))
    assert len(sent) > 3 and max(b.nbytes for b in sent) < 3 << 20
    got = pa.Table.from_batches(sent)
    ids = b"".join(got["payload"].to_pylist())
    assert ids == b"".join(packing.ChunkTokenizer(tokenizer_path(), 2).batch(texts))
    assert sorted(set(got["doc_id"].to_pylist())) == list(range(40)) and sum(got["length"].to_pylist()) == len(ids) // 4


def test_workers_keep_nothing_of_a_pipeline_task(spark, folder, monkeypatch):
    """What a task freed goes back to the system, as its worker waits beside the busy ones."""
    import ctypes
    import gc
    import re

    import pyarrow as pa

    import public_tokenizers

    libc = ctypes.CDLL(None)
    if not hasattr(libc, "malloc_trim"):
        pytest.skip("no GNU C library")

    def held():
        with open("/proc/self/smaps_rollup") as file:
            return int(re.search(r"\nPss_Anon:\s+(\d+)", file.read())[1]) / 1024

    tasks, made = [], type(spark.range(1)).mapInArrow

    def noted(df, task, schema, *args, **kwargs):
        tasks.append((df.columns, task))
        return made(df, task, schema, *args, **kwargs)

    docs = stored(spark, folder)
    monkeypatch.setattr(type(docs), "mapInArrow", noted)
    packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))
    jaccard_join.described(docs, buckets=4)
    toxicity._counts(docs.select("text"), None)
    rng = np.random.default_rng(7)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz"))
    texts = [" ".join("".join(rng.choice(letters, 7)) for _ in range(400)) for _ in range(400)]
    columns = {"doc_id": range(400), "text": texts, "_row": range(400)}
    monkeypatch.setattr(jaccard_join, "block_number", lambda number: number)
    ran = 0
    for names, task in tasks:
        if "text" in names:
            batch = pa.RecordBatch.from_pydict({n: pa.array(columns[n]) for n in names})
            for _ in task(iter([batch] * 2)):
                pass
            # What nobody refers to any more is gone without the collector of cycles.
            kept = held()
            gc.collect()
            pa.default_memory_pool().release_unused()
            libc.malloc_trim(0)
            assert kept - held() < 4, task
            ran += 1
    assert ran == 3


def test_tokenizers_of_earlier_tasks_leave_nothing():
    import ctypes

    libc = ctypes.CDLL(None)
    if not hasattr(libc, "mallinfo2"):
        pytest.skip("no GNU C library")
    fields = "arena ordblks smblks hblks hblkhd usmblks fsmblks uordblks fordblks keepcost".split()
    libc.mallinfo2.restype = type("Mallinfo", (ctypes.Structure,), {"_fields_": [(f, ctypes.c_size_t) for f in fields]})

    def used():
        info = libc.mallinfo2()
        return (info.uordblks + info.hblkhd) / (1 << 20)

    rng = np.random.default_rng(8)
    letters = np.array(list("etaoinshrdlu"))
    text = " ".join("".join(rng.choice(letters, 7)) for _ in range(20_000)).encode()
    after = []
    for _ in range(4):
        for _ in packing.ChunkTokenizer(tokenizer_path(), 2).batch([text]):
            pass
        after.append(used())
    assert after[-1] - after[0] < 4, after
