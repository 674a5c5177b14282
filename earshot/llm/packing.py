"""Packing token pieces into windows by Karmarkar-Karp multiway differencing."""

from __future__ import annotations

import heapq
import json
import math
import os
from array import array
from codecs import charmap_decode
from collections.abc import Callable, Iterator
from functools import partial
from itertools import pairwise
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.llm.common import as_bytes, give_back, slices, texts, tidy

if TYPE_CHECKING:
    from tokenizers import Tokenizer

CAPACITY = 4096
END_ID = 2
# Pieces that are spread over windows together; the blocks are independent.
BLOCK_PIECES = 1000
# Parts of one generation whose ids a task remembers until it ends (some 35 MB), and the longest one it does.
MEMORY, LONGEST = 260_000, 64
# Places in which is marked what was met once. Two parts at one place only make the second be remembered at once.
MARKS = 1 << 22
# Steps of a tokenizer under which a word's ids do not depend on the stops behind it.
WORD_STEPS = {
    "normalizer": {
        "type": "Sequence",
        "normalizers": [
            {"type": "NFC"},
            {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
            {"type": "Lowercase"},
        ],
    },
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {
                "type": "Split",
                "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
                "behavior": "Removed",
                "invert": True,
            },
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}
# ASCII marks, and the Latin letters that are (A-Z, a-z and those of Latin-1, all composed) words.
_STOPS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum())
_LETTERS = "".join(c for c in map(chr, [*range(65, 91), *range(97, 123), *range(192, 256)]) if c.isalpha())
# The character that byte-level vocabularies write for each byte: others in place of unprintable ones.
_UNPRINTABLE = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174)]
_BYTE_LETTERS = "".join(chr(256 + _UNPRINTABLE.index(b) if b in _UNPRINTABLE else b) for b in range(256))


def _plain_ids(tokenizer: Tokenizer, part: bytes) -> bytes:
    return array("I", tokenizer.encode(part.decode(), add_special_tokens=False).ids).tobytes()


def _part_ids(tokenizer: Tokenizer, tokenize: Callable, by_word: bool, part: bytes) -> bytes:
    if not by_word or len(part) > LONGEST:
        return _plain_ids(tokenizer, part)
    if not part.isalpha() and part.decode().strip(_LETTERS):
        return _plain_ids(tokenizer, part)
    return array("I", [t.id for t in tokenize(charmap_decode(part, "strict", _BYTE_LETTERS)[0])]).tobytes()


class ChunkTokenizer:
    """Token ids of whole texts, put together from those of their chunks.

    The tokenizer drops white space and never joins across it, so a text's ids
    are those of its chunks between ASCII white space, one after the other. Of
    the chunks of some texts every different one is looked at once. One that is a
    word of Latin letters and stops behind it is put together from both, if the
    tokenizer's steps are the ones that makes right (lower case, words apart from
    stops, byte-level pairs). A part met before is looked up, a new word goes
    through the pairs alone, any other part is handed to the tokenizer.
    """

    def __init__(self, path: str, end_id: int):
        # One thread per task: Spark runs as many tasks as there are cores.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        # Its own memory of words outlives it, some 4 MB for every task; words are remembered here.
        resize = getattr(tokenizer.model, "_resize_cache", None)
        if resize is not None:
            resize(0)
        self.end = array("I", [end_id]).tobytes()
        with open(path, "rb") as file:
            steps = json.loads(file.read())
        # A token of its own, as <|endoftext|>, must not stand inside a word and the stops behind it either.
        own = all(t["content"].rstrip(_STOPS).strip(_LETTERS) for t in steps.get("added_tokens") or [])
        self.by_word = own and {k: steps[k] for k in WORD_STEPS} == WORD_STEPS
        # Nothing here refers back to its owner, so all of it goes with the last one who uses it.
        self.known = _Known(partial(_part_ids, tokenizer, tokenizer.model.tokenize, self.by_word), repeated=True)
        del steps
        # Reading the vocabulary takes much more than keeping it.
        give_back()

    def batch(self, raw: list[bytes]) -> Iterator[bytes]:
        """Little-endian unsigned 32-bit ids of each text, the end id last."""
        chunks = pc.ascii_split_whitespace(pa.array(raw, pa.string()))
        coded = chunks.values.dictionary_encode()
        ids = self._chunk_ids(coded.dictionary).take(coded.indices)
        places = np.frombuffer(ids.buffers()[1], np.int64, len(ids) + 1)[chunks.offsets.to_numpy()].tolist()
        data = memoryview(ids.buffers()[2] or b"")
        for first, last in pairwise(places):
            yield b"".join((data[first:last], self.end))

    def _chunk_ids(self, chunks: pa.StringArray) -> pa.LargeBinaryArray:
        """Ids of different chunks."""
        if not self.by_word:
            return self._part_ids(chunks)
        words, stops = pc.ascii_rtrim(chunks, _STOPS), pc.utf8_ltrim(chunks, _LETTERS)
        size = pc.binary_length(chunks)
        apart = pc.and_(
            pc.equal(pc.add(pc.binary_length(words), pc.binary_length(stops)), size), pc.less_equal(size, LONGEST)
        )
        heads = pc.if_else(apart, pc.utf8_lower(words), chunks)
        return pc.binary_join_element_wise(
            self._part_ids(heads), self._part_ids(pc.if_else(apart, stops, "")), pa.scalar(b"", pa.large_binary())
        )

    def _part_ids(self, parts: pa.StringArray) -> pa.LargeBinaryArray:
        coded = parts.dictionary_encode()
        different = coded.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False)
        return pa.array(list(map(self.known.__getitem__, different)), pa.large_binary()).take(coded.indices)


class _Known(dict):
    """Ids of short parts of texts, made when they are asked for first.

    When a generation is full it becomes the one before, so that what is asked for often stays.
    With ``repeated`` a part is kept when it is made for the second time.
    """

    def __init__(self, make: Callable[[bytes], bytes], repeated: bool = False):
        super().__init__()
        self.make = make
        self.before: dict[bytes, bytes] = {}
        self.met = bytearray(MARKS) if repeated else None

    def __missing__(self, part: bytes) -> bytes:
        ids = self.before.get(part)
        if ids is None:
            ids = self.make(part)
            if self.met is not None:
                place = hash(part) % MARKS
                if not self.met[place]:
                    self.met[place] = 1
                    return ids
        if 0 < len(part) <= LONGEST:
            if len(self) >= MEMORY:
                # The oldest go before the copy is made, so that there are never three generations.
                self.before.clear()
                self.before.update(self)
                self.clear()
                if self.met is not None:
                    self.met = bytearray(MARKS)
            self[part] = ids
        return ids


def differencing(sizes: np.ndarray, windows: int) -> tuple[np.ndarray, int]:
    """Window of each item and the largest sum, by Karmarkar-Karp differencing.

    Every item starts as a partial partition of its own. The two with the
    largest spread are merged again and again, the fullest window of one with
    the emptiest of the other, until one is left.
    """
    count = len(sizes)
    left, right = np.full(2 * count, -1, np.int64), np.full(2 * count, -1, np.int64)
    fresh = count
    heap = [(-int(s), i) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    # Sums in falling order and, in the same places, the node that holds a window's items.
    parts: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    serial = count

    def part(i: int) -> tuple[np.ndarray, np.ndarray]:
        if i in parts:
            return parts.pop(i)
        return np.array([sizes[i]], np.int64), np.array([i], np.int64)

    while len(heap) > 1:
        a_sums, a_nodes = part(heapq.heappop(heap)[1])
        b_sums, b_nodes = part(heapq.heappop(heap)[1])
        used = min(windows, len(a_sums) + len(b_sums))
        sums, nodes, others = np.zeros(used, np.int64), np.full(used, -1, np.int64), np.full(used, -1, np.int64)
        sums[: len(a_sums)], nodes[: len(a_nodes)] = a_sums, a_nodes
        sums[used - len(b_sums) :] += b_sums[::-1]
        others[used - len(b_nodes) :] = b_nodes[::-1]
        both = np.nonzero((nodes >= 0) & (others >= 0))[0]
        if fresh + len(both) > len(left):
            grow = max(len(left), len(both))
            left, right = (np.concatenate([x, np.full(grow, -1, np.int64)]) for x in (left, right))
        made = np.arange(fresh, fresh + len(both))
        left[made], right[made] = nodes[both], others[both]
        fresh += len(both)
        merged = np.where(nodes >= 0, nodes, others)
        merged[both] = made
        order = np.argsort(-sums, kind="stable")
        sums, merged = sums[order], merged[order]
        spread = int(sums[0]) - (int(sums[-1]) if used == windows else 0)
        parts[serial] = sums, merged
        heapq.heappush(heap, (-spread, serial))
        serial += 1
    sums, nodes = part(heap[0][1])
    window = np.full(fresh, -1, np.int64)
    window[nodes] = np.arange(len(nodes))
    for node in range(fresh - 1, count - 1, -1):
        window[left[node]] = window[right[node]] = window[node]
    return window[:count], int(sums[0])


def spread_over_windows(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Window of each item; the window count rises until the fullest one fits."""
    windows = max(1, math.ceil(int(sizes.sum()) / capacity))
    while True:
        window, largest = differencing(sizes, windows)
        if largest <= capacity:
            return window
        windows += max(1, int(windows * (largest - capacity) / capacity))


def _pieces(
    batch: pa.RecordBatch, tokenizer: ChunkTokenizer, capacity: int, payload: Callable[[bytes], bytes]
) -> Iterator[pa.RecordBatch]:
    """Pieces of the documents of a batch, those of some 1 MB of text at a time."""
    doc_ids = batch.column("doc_id").to_pylist()
    for first, raw in slices(as_bytes(batch.column("text"))):
        ids, starts, lengths, payloads, totals = [], [], [], [], []
        for doc_id, tokens in zip(doc_ids[first:], tokenizer.batch(raw)):
            total = len(tokens) // 4
            for start in range(0, total, capacity):
                piece = tokens[4 * start : 4 * (start + capacity)]
                ids.append(doc_id)
                starts.append(start)
                lengths.append(len(piece) // 4)
                payloads.append(payload(piece))
                totals.append(total)
        long = pa.int64()
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, long), pa.array(starts, long), pa.array(lengths, long)]
            + [pa.array(payloads, pa.binary()), pa.array(totals, long)],
            ["doc_id", "start", "length", "payload", "doc_tokens"],
        )


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    payload: Callable[[bytes], bytes] = bytes,
) -> DataFrame:
    """Pieces of all documents with their places in sequences of at most ``capacity`` tokens.

    A document is its token ids and the end id, cut at multiples of
    ``capacity``. Full pieces are sequences of their own; the others are dealt by
    a hash into blocks of some ``BLOCK_PIECES`` and each block is spread over
    near-equal windows by Karmarkar-Karp differencing. ``payload`` turns a
    piece's ids (little-endian, 32 bits) into the column of that name: the ids
    themselves unless told otherwise.

    Columns: ``doc_id, start, length, payload, doc_tokens, sequence_id, offset``.
    A null or empty text is its end id. Repeated rows are packed each. A very long text is
    so many full pieces and a rest. Pieces of equal length are taken in the order of doc_id and start. Columns
    other than ``doc_id`` and ``text`` play no part; no rows give no pieces.
    """

    @tidy
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = ChunkTokenizer(tokenizer_path, end_id)
        for batch in batches:
            yield from _pieces(batch, tokenizer, capacity, payload)

    columns = "doc_id long, start long, length long, payload binary, doc_tokens long"
    blocks = max(1, math.ceil(docs.count() / BLOCK_PIECES))
    pieces = texts(docs).mapInArrow(cut, columns)
    dealt = pieces.withColumn("_block", F.pmod(F.xxhash64("doc_id", "start", "payload"), F.lit(blocks)).cast("long"))

    def place(table: pa.Table) -> pa.Table:
        # What the block before took.
        give_back()
        length = table["length"].to_numpy()
        doc_id = table["doc_id"].to_numpy()
        order = np.lexsort((table["start"].to_numpy(), doc_id))
        table = table.take(pa.array(order))
        length = length[order]
        window = np.full(len(length), -1, np.int64)
        short = length < capacity
        if short.any():
            window[short] = spread_over_windows(length[short], capacity)
        window[~short] = window.max(initial=-1) + 1 + np.arange(int((~short).sum()))
        by_window = np.argsort(window, kind="stable")
        before = np.concatenate([[0], np.cumsum(length[by_window])])[:-1]
        first = np.concatenate([[True], np.diff(window[by_window]) > 0])
        base = np.maximum.accumulate(np.where(first, before, 0))
        offset = np.empty(len(length), np.int64)
        offset[by_window] = before - base
        sequence = table["_block"].to_numpy() * (1 << 32) + window
        return (
            table.drop_columns(["_block"])
            .append_column("sequence_id", pa.array(sequence, pa.int64()))
            .append_column("offset", pa.array(offset, pa.int64()))
        )

    return dealt.groupBy("_block").applyInArrow(place, columns + ", sequence_id long, offset long")
