"""Removal of repeated byte strings by a distributed merge sort of suffixes.

Every string of ``length`` bytes has an anchor: the piece of ``GRAM`` bytes in it
whose hash is least, the leftmost of equals. Equal strings have equal anchors
at equal places, so only text around anchors that occur more than once can
hold a repeat. Strings that follow one another and share an anchor are one
*segment*. Segments around repeated anchors are sorted as suffixes that begin
at the anchor (what stands left of it follows, read backwards): tasks sort runs
of them, exchange the runs front-coded and cut by sampled splitters, and merge
them by a loser tree that knows common prefixes. In the order of suffixes equal
segments are neighbours, and segments with a common anchor stand together.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.llm.blocks import BLOCKS, block_number, by_bucket, pack40, read_ipc, records, to_ipc, unpack40
from earshot.llm.common import as_bytes, key_parts, numbered, row_lists, settled, with_listed
from earshot.session import scratch_path

LENGTH, GRAM = 100, 40
# Bytes hashed at a time, segments sorted as one run, sampled segments per partition.
SLICE_BYTES, RUN_SEGMENTS, SAMPLE = 2 << 20, 200_000, 64
_PLACE = np.uint64((1 << 24) - 1)
_LAST = np.iinfo(np.int64).max
_TURNS = [
    np.uint64(x)
    for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x9FB21C651E98DF25, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)
]
_BYTES = (np.arange(1, 257, dtype=np.uint64) * _TURNS[4]) ^ (np.arange(256, dtype=np.uint64) << np.uint64(40)) | np.uint64(1)
#: Where a segment lies: number of its text, first string, strings after the first, bytes left of the anchor.
SEGMENT = np.dtype([("text", "<u4"), ("start", "<u4"), ("more", "u1"), ("left", "u1")])
#: Rank of a segment or string: earlier is smaller.
RANK = np.dtype([("doc", "<i8"), ("row", "<i8"), ("start", "<u4")])
COVER = np.dtype([("row", "<i8"), ("start", "<u4"), ("end", "<u4")])


def _gram_hashes(buffer: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` bytes (32 to 64) from every place on, by doubling."""
    hashes, width, turn = _BYTES[buffer], 1, 0
    while width * 2 <= size:
        hashes = hashes[:-width] * _TURNS[turn] + hashes[width:]
        hashes ^= hashes >> np.uint64(31)
        width, turn = width * 2, turn + 1
    if width < size:
        hashes = hashes[: width - size] * _TURNS[5] + hashes[size - width :]
    hashes *= _TURNS[0]
    hashes ^= hashes >> np.uint64(29)
    return hashes


def _least_over(values: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while span * 2 <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    if span < width:
        values = np.minimum(values[: span - width], values[width - span :])
    return values


def _cut(raw: list[bytes], length: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """Text number, first byte and bytes, in slices of bounded size; a longer text comes in overlapping parts."""
    slice_, held = [], 0
    for number, text in enumerate(raw):
        for base in range(0, len(text) - length + 1, SLICE_BYTES):
            part = text[base : base + SLICE_BYTES + length - 1]
            if held and held + len(part) > SLICE_BYTES:
                yield slice_
                slice_, held = [], 0
            slice_.append((number, base, part))
            held += len(part)
    if slice_:
        yield slice_


def segments(raw: list[bytes], length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Segments of all texts in order, and the hash of each one's anchor."""
    found, keys = [np.zeros(0, SEGMENT)], [np.zeros(0, np.uint64)]
    for parts in _cut(raw, length):
        buffer = np.frombuffer(b"\n".join(p for _, _, p in parts) + b"\n", np.uint8)
        starts = np.zeros(len(parts) + 1, np.int64)
        np.cumsum([len(p) + 1 for _, _, p in parts], out=starts[1:])
        hashes = _gram_hashes(buffer, gram)
        marked = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
        anchor = (_least_over(marked, length - gram + 1) & _PLACE).astype(np.int32)
        inside = np.zeros(len(anchor), bool)
        for begin, end in zip(starts.tolist(), starts[1:].tolist()):
            inside[begin : end - length] = True
        change = np.ones(len(anchor) + 1, bool)
        change[1:-1] = (anchor[1:] != anchor[:-1]) | (inside[1:] != inside[:-1])
        first = np.flatnonzero(change[:-1] & inside)
        last = np.flatnonzero(change[1:] & inside)
        part = np.searchsorted(starts, first, "right") - 1
        base = np.array([b for _, b, _ in parts], np.int64)[part] - starts[part]
        own = np.zeros(len(first), SEGMENT)
        own["text"] = np.array([n for n, _, _ in parts], np.int64)[part]
        own["start"] = first + base
        own["more"] = last - first
        own["left"] = anchor[first] - first
        found.append(own)
        keys.append(hashes[anchor[first]])
    return np.concatenate(found), np.concatenate(keys)


def candidates(docs: DataFrame, length: int = LENGTH, buckets: int | None = None) -> DataFrame:
    """``doc_id, _row, segments``: what each row has around anchors that occur more than once.

    Anchors meet in buckets of their hash: a block of documents sends those that
    are single in it, and once each of the others, and gets back the segments
    that are known elsewhere. 40 bits and the bucket stand for an anchor; a
    chance meeting only adds a segment to the sort.
    """
    buckets = buckets or key_parts(docs)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, batch in enumerate(batches):
            if not batch.num_rows:
                continue
            block = block_number(number)
            own, keys = segments(as_bytes(batch.column("text")), length)
            order = np.argsort(keys, kind="stable")
            own, keys = own[order], keys[order]
            first = np.ones(len(keys), bool)
            first[1:] = keys[1:] != keys[:-1]
            last = np.ones(len(keys), bool)
            last[:-1] = first[1:]
            single = first & last
            shared = keys[first & ~single]
            several = dict(by_bucket(shared, buckets))
            alone, places = keys[single], own[single]
            short = lambda k: pack40(k // np.uint64(buckets))
            rows = []
            for bucket, at in by_bucket(alone, buckets):
                more = several.pop(bucket, np.zeros(0, np.int64))
                rows.append((bucket, block, False, short(alone[at]), places[at].tobytes(), short(shared[more])))
            rows += [(bucket, block, False, b"", b"", short(shared[more])) for bucket, more in several.items()]
            head = to_ipc(batch.select(["doc_id", "_row"]))
            rows.append((block % buckets, block, True, head, own[~single].tobytes(), b""))
            yield records(rows)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple]] = {}
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                if row[2]:
                    yield records([row])
                else:
                    held.setdefault(row[0], []).append(row)
        for rows in held.values():
            keys = [unpack40(r[3]) for r in rows]
            more = [unpack40(r[5]) for r in rows]
            every = np.sort(np.concatenate(keys + more + more))
            again = np.unique(every[1:][every[1:] == every[:-1]])
            for row, own in zip(rows, keys):
                if len(own) and len(again):
                    place = np.minimum(np.searchsorted(again, own), len(again) - 1)
                    places = np.frombuffer(row[4], SEGMENT)[again[place] == own]
                    if len(places):
                        yield records([(row[0], row[1], False, b"", places.tobytes(), b"")])

    def merge(table: pa.Table) -> pa.Table:
        head = read_ipc(table["keys"][table["info"].to_pylist().index(True)].as_py())
        own = np.concatenate([np.frombuffer(x, SEGMENT) for x in table["owners"].to_pylist()])
        own = own[np.lexsort((own["start"], own["text"]))]
        texts, cuts = np.unique(own["text"], return_index=True)
        ends = np.append(cuts[1:], len(own))
        lists = [own[a:b].tobytes() for a, b in zip(cuts.tolist(), ends.tolist())]
        picked = head.take(pa.array(texts.astype(np.int64)))
        return picked.append_column("segments", pa.array(lists, pa.binary()))

    met = numbered(docs).mapInArrow(send, BLOCKS).repartition(buckets, "bucket").mapInArrow(meet, BLOCKS)
    return met.groupBy("block").applyInArrow(merge, "doc_id long, _row long, segments binary")


class Run(NamedTuple):
    """Suffixes in order, what each shares with the one before, and their ranks."""

    strings: list[bytes]
    shared: list[int]
    ranks: list[tuple[int, int, int]]


def suffix_of(text: bytes, start: int, more: int, left: int, length: int) -> bytes:
    """Bytes from the anchor on, those left of it backwards, and their number."""
    anchor = start + left
    return text[anchor : start + more + length] + text[start:anchor][::-1] + bytes([left])


def segment_of(suffix: bytes) -> bytes:
    left = suffix[-1]
    return suffix[-1 - left : -1][::-1] + suffix[: -1 - left]


def common_prefix(a: bytes, b: bytes, known: int) -> int:
    """Bytes that ``a`` and ``b`` share, of which ``known`` need no comparison."""
    size = min(len(a), len(b)) - known
    x = int.from_bytes(a[known : known + size], "big") ^ int.from_bytes(b[known : known + size], "big")
    return known + size - (x.bit_length() + 7) // 8 if x else known + size


def encode_run(run: Run) -> tuple[bytes, bytes, bytes]:
    """Front-coded strings (compressed), shared and whole sizes, and ranks."""
    tails = b"".join([s[n:] for s, n in zip(run.strings, run.shared)])
    sizes = np.array([run.shared, [len(s) for s in run.strings]], "<u2")
    return bytes(pa.compress(tails, "zstd", asbytes=True)), sizes.tobytes(), np.array(run.ranks, RANK).tobytes()


def decode_run(tails: bytes, sizes: bytes, ranks: bytes) -> Run:
    shared, whole = np.frombuffer(sizes, "<u2").reshape(2, -1).tolist()
    tails = pa.decompress(tails, sum(whole) - sum(shared), "zstd", asbytes=True)
    strings, at, before = [], 0, b""
    for known, size in zip(shared, whole):
        end = at + size - known
        before = before[:known] + tails[at:end]
        strings.append(before)
        at = end
    return Run(strings, shared, np.frombuffer(ranks, RANK).tolist())


def merged(runs: list[Run]) -> Iterator[tuple[bytes, int, tuple[int, int, int]]]:
    """All suffixes of sorted runs in order, with what each shares with the one before; equal ones by rank.

    A loser tree. With every candidate is kept what it shares with the winner it
    lost to. Of two candidates the one that shares more with the last winner is
    smaller, and the other keeps its number; only if they share equally much are
    bytes compared, from there on.
    """
    count = 1
    while count < len(runs):
        count *= 2
    strings = [iter(r.strings) for r in runs]
    shares = [iter(r.shared) for r in runs]
    ranks = [iter(r.ranks) for r in runs]
    heads: list[bytes | None] = [next(s, None) for s in strings] + [None] * (count - len(runs))
    orders = [next(r, None) for r in ranks] + [None] * (count - len(runs))
    known = [0] * count
    for s in shares:
        next(s, None)

    def play(a: int, b: int) -> tuple[int, int]:
        """Winner and loser; the loser's share is put right."""
        x, y = heads[a], heads[b]
        if x is None or y is None:
            return (b, a) if x is None else (a, b)
        p, q = known[a], known[b]
        if p != q:
            return (a, b) if p > q else (b, a)
        n = common_prefix(x, y, p)
        if n == len(x) == len(y):
            smaller = orders[a] < orders[b]
        else:
            smaller = x[n : n + 1] < y[n : n + 1]
        if smaller:
            known[b] = n
            return a, b
        known[a] = n
        return b, a

    losers = [0] * count
    winners = [0] * count + list(range(count))
    for node in range(count - 1, 0, -1):
        winners[node], losers[node] = play(winners[2 * node], winners[2 * node + 1])
    best = winners[1] if count > 1 else 0
    while heads[best] is not None:
        yield heads[best], known[best], orders[best]
        heads[best] = next(strings[best], None)
        known[best] = next(shares[best], 0)
        orders[best] = next(ranks[best], None)
        node = (best + count) // 2
        while node:
            best, losers[node] = play(best, losers[node])
            node //= 2


_RUNS = "part int, strings binary, sizes binary, ranks binary"
_COVERS = "bucket int, covers binary, windows binary, ranks binary"


def _suffixes(batch: pa.RecordBatch, length: int) -> Iterator[tuple[list[bytes], list[tuple[int, int, int]]]]:
    """Suffixes and ranks of a batch of candidates, as many as are sorted at a time."""
    strings, ranks = [], []
    columns = (batch.column(c) for c in ("doc_id", "_row", "segments"))
    for text, doc, row, own in zip(as_bytes(batch.column("text")), *[c.to_pylist() for c in columns]):
        doc = _LAST if doc is None else doc
        for _, start, more, left in np.frombuffer(own, SEGMENT).tolist():
            strings.append(suffix_of(text, start, more, left, length))
            ranks.append((doc, row, start))
        if len(strings) >= RUN_SEGMENTS:
            yield strings, ranks
            strings, ranks = [], []
    if strings:
        yield strings, ranks


def _covers(rows: list[tuple[int, int, int]], buckets: int) -> pa.RecordBatch:
    """Covered bytes (row, start, end), packed by bucket of the row."""
    own = np.array(rows, COVER)
    groups = list(by_bucket(own["row"].astype(np.uint64), buckets))
    blank = [None] * len(groups)
    return _cover_batch([b for b, _ in groups], [own[at].tobytes() for _, at in groups], blank, blank)


def _cover_batch(*columns) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary())
    names = ["bucket", "covers", "windows", "ranks"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def sorted_runs(strings: list[bytes], ranks: list[tuple[int, int, int]]) -> tuple[Run, list[tuple[int, int, int]]]:
    """The suffixes as a run without equals, and the ranks of those that an earlier one equals."""
    order = sorted(range(len(strings)), key=ranks.__getitem__)
    order.sort(key=strings.__getitem__)
    kept, later, shared, before = [], [], [], None
    for i in order:
        own = strings[i]
        if own == before:
            later.append((ranks[i], own))
            continue
        kept.append(i)
        before = own
    strings, ranks = [strings[i] for i in kept], [ranks[i] for i in kept]
    if strings:
        width = max(1, *map(len, strings))
        table = np.frombuffer(b"".join([s.ljust(width, b"\0") for s in strings]), np.uint8).reshape(-1, width)
        sizes = np.array([len(s) for s in strings])
        differ = table[1:] != table[:-1]
        first = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
        shared = [0, *np.minimum(first, np.minimum(sizes[1:], sizes[:-1])).tolist()]
    return Run(strings, shared, ranks), later


def _size(suffix: bytes) -> int:
    """Bytes of the segment."""
    return len(suffix) - 1


def _repeats_in(
    group: list[tuple[bytes, tuple[int, int, int]]], length: int, seen: dict[bytes, tuple[int, int, int]]
) -> Iterator[tuple[int, int, int]]:
    """Bytes covered by strings that an earlier segment of the group holds; ``seen`` gets the first of each string."""
    for suffix, (doc, row, start) in sorted(group, key=lambda x: x[1]):
        text = segment_of(suffix)
        begin = end = -1
        for at in range(len(text) - length + 1):
            string = text[at : at + length]
            if string in seen:
                if begin < 0 or start + at > end:
                    if begin >= 0:
                        yield row, begin, end
                    begin = start + at
                end = start + at + length
            else:
                seen[string] = doc, row, start + at
        if begin >= 0:
            yield row, begin, end


def _packed_windows(seen: dict[bytes, tuple[int, int, int]], buckets: int) -> pa.RecordBatch:
    """Strings and ranks, a row per bucket of the strings."""
    own = list(seen)
    bucket = np.array([zlib.crc32(w) for w in own], np.uint64)
    ranks = np.array([seen[w] for w in own], RANK)
    groups = list(by_bucket(bucket, buckets))
    return _cover_batch(
        [b for b, _ in groups],
        [None] * len(groups),
        [b"".join([own[i] for i in at.tolist()]) for _, at in groups],
        [ranks[at].tobytes() for _, at in groups],
    )


def _settle_windows(packed: DataFrame, buckets: int, length: int) -> DataFrame:
    """Covers of the strings that several parts hold: all but the earliest."""

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first: dict[bytes, tuple[int, int, int]] = {}
        covers = []
        for batch in batches:
            for windows, ranks in zip(batch.column("windows").to_pylist(), batch.column("ranks").to_pylist()):
                for i, rank in enumerate(np.frombuffer(ranks, RANK).tolist()):
                    window = windows[i * length : (i + 1) * length]
                    known = first.get(window)
                    if known is None or rank < known:
                        first[window], rank = rank, known
                    if rank is not None:
                        covers.append((rank[1], rank[2], rank[2] + length))
        if covers:
            yield _covers(covers, buckets)

    return packed.repartition(buckets, "bucket").mapInArrow(settle, _COVERS)


def _merge_parts(found: DataFrame, buckets: int, length: int, gram: int) -> DataFrame:
    """Covered bytes of the runs of each part, and the strings of groups that may go on in the next part.

    Of those strings the first in the part travels on, packed by bucket.
    """

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, list[Run]] = {}
        for batch in batches:
            for part, strings, sizes, ranks in zip(*[c.to_pylist() for c in batch.columns]):
                if sizes is None:
                    yield _covers(np.frombuffer(ranks, COVER).tolist(), buckets)
                else:
                    parts.setdefault(part, []).append(decode_run(strings, sizes, ranks))
        for runs in parts.values():
            covers, edges = [], []
            group: list[tuple[bytes, tuple[int, int, int]]] = []
            leading = True

            def close(at_edge: bool) -> None:
                if at_edge:
                    edges.extend(group)
                elif len(group) > 1:
                    covers.extend(_repeats_in(group, length, {}))

            before = b""
            for suffix, shared, rank in merged(runs):
                if shared == len(suffix) == len(before):
                    covers.append((rank[1], rank[2], rank[2] + _size(suffix)))
                    continue
                before = suffix
                if group and shared < gram:
                    close(leading)
                    leading = False
                    group = []
                group.append((suffix, rank))
                if len(covers) > RUN_SEGMENTS:
                    yield _covers(covers, buckets)
                    covers = []
            if group:
                close(True)
            seen: dict[bytes, tuple[int, int, int]] = {}
            covers.extend(_repeats_in(edges, length, seen))
            if covers:
                yield _covers(covers, buckets)
            if seen:
                yield _packed_windows(seen, buckets)

    return found.repartitionById(buckets, F.col("part")).mapInArrow(merge, _COVERS)


def _splitters(found: DataFrame, rows: int, parts: int, length: int) -> list[bytes]:
    """Suffixes that cut the order into parts of about equal size, from a sample of bounded size per part."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dice = np.random.default_rng(batch.num_rows)
            for strings, _ in _suffixes(batch, length):
                some = dice.integers(0, len(strings), min(len(strings), 2 * batch.num_rows))
                yield pa.RecordBatch.from_arrays([pa.array([strings[i] for i in some], pa.binary())], ["suffix"])

    sample = found.sample(min(1.0, SAMPLE * parts / max(rows, 1)), seed=1).mapInArrow(pick, "suffix binary")
    seen = sorted(bytes(r[0]) for r in sample.collect())
    return [seen[len(seen) * i // parts] for i in range(1, parts)] if seen else []


def _stored(df: DataFrame, label: str) -> DataFrame:
    """Like ``session.fixed``, with the stronger compression that texts repay."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _spans(packed: bytes) -> np.ndarray:
    """Covered bytes as maximal runs, a row of start and end each."""
    own = np.frombuffer(packed, "<u4").reshape(-1, 2).astype(np.int64)
    own = own[np.lexsort((own[:, 1], own[:, 0]))]
    reach = np.maximum.accumulate(own[:, 1])
    opens = np.ones(len(own), bool)
    opens[1:] = own[1:, 0] > reach[:-1]
    closes = np.append(opens[1:], True)
    return np.stack([own[opens, 0], reach[closes]], axis=1)


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Rows that lose bytes: ``doc_id, _row``, the removed ``spans`` in order and the ``kept`` bytes.

    Texts are UTF-8 bytes. A byte goes if a string of ``length`` bytes that covers
    it also starts earlier: in a row of smaller doc_id (null comes last; of equal
    doc_ids the row read first), or earlier in the same text. Strings never cross
    texts and are judged on the input. Texts shorter than ``length``, empty and null
    ones lose nothing and do not appear; nor does anything of an empty table. A very long text is
    sorted in slices. Other columns play no part. Scans look up what is listed for their split, so
    texts are moved only as suffixes to be sorted.
    """
    if not 32 <= gram <= 64 or not gram < length <= 156 + gram:
        raise ValueError("anchors are 32 to 64 bytes and strings at most 156 bytes longer")
    docs = settled(docs)
    buckets = key_parts(docs)
    around = row_lists(candidates(docs, length, buckets).select("_row", "segments"))
    found = _stored(with_listed(numbered(docs), around, "segments", "binary"), "segments")
    splitters = _splitters(found, found.count(), buckets, length)

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary())
        for batch in batches:
            for strings, ranks in _suffixes(batch, length):
                run, later = sorted_runs(strings, ranks)
                cuts = [0, *[bisect_left(run.strings, s) for s in splitters], len(run.strings)]
                rows = []
                if later:
                    covers = np.array([(r[1], r[2], r[2] + _size(s)) for r, s in later], COVER)
                    rows.append((later[0][0][1] % buckets, None, None, covers.tobytes()))
                for part, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    if a < b:
                        own = Run(run.strings[a:b], [0, *run.shared[a + 1 : b]], run.ranks[a:b])
                        rows.append((part, *encode_run(own)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["part", "strings", "sizes", "ranks"]
                )

    merged_parts = _stored(_merge_parts(found.mapInArrow(runs, _RUNS), buckets, length, gram), "covers")
    edge_covers = _settle_windows(merged_parts.filter("windows IS NOT NULL"), buckets, length)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Covers of a bucket, one row per document and part."""
        for batch in batches:
            for packed in batch.column("covers").to_pylist():
                own = np.frombuffer(packed, COVER)
                own = own[np.argsort(own["row"], kind="stable")]
                rows, cuts = np.unique(own["row"], return_index=True)
                ends = np.append(cuts[1:], len(own)).tolist()
                pairs = np.stack([own["start"], own["end"]], axis=1).astype("<u4")
                lists = [pairs[a:b].tobytes() for a, b in zip(cuts.tolist(), ends)]
                yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array(lists, pa.binary())], ["_row", "covers"])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Covers of the documents of some buckets, one row per document."""
        held: dict[int, list[bytes]] = {}
        for batch in unpack(batches):
            for row, packed in zip(*[c.to_pylist() for c in batch.columns]):
                held.setdefault(row, []).append(packed)
        names = list(held)
        for first in range(0, len(names), 5000):
            some = names[first : first + 5000]
            lists = [_spans(b"".join(held.pop(n))).astype("<u4").tobytes() for n in some]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(lists, pa.binary())], ["_row", "covers"])

    whole = merged_parts.filter("covers IS NOT NULL").select("bucket", "covers")

    by_row = (
        whole.unionByName(edge_covers.select("bucket", "covers"))
        .repartition(buckets, "bucket")
        .select("covers")
        .mapInArrow(gather, "_row long, covers binary")
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            if not batch.num_rows:
                continue
            kept, lists = [], []
            for text, covers in zip(as_bytes(batch.column("text")), batch.column("covers").to_pylist()):
                spans = _spans(covers).tolist()
                edges = [0, *[x for s in spans for x in s], len(text)]
                kept.append(b"".join([text[a:b] for a, b in zip(edges[::2], edges[1::2])]))
                lists.append([{"start": a, "end": b} for a, b in spans])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("_row"), pa.array(lists, span), pa.array(kept, pa.binary())],
                ["doc_id", "_row", "spans", "kept"],
            )

    schema = "doc_id long, _row long, spans array<struct<start:long,end:long>>, kept binary"
    covered = with_listed(numbered(docs), row_lists(by_row), "covers", "binary")
    return covered.mapInArrow(cut, schema)
