"""Benchmark passages in documents, found by exact pieces and verified by edit distance."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.llm.common import as_bytes, listed_rows, numbered, row_lists, settled, tidy
from earshot.session import fixed
from earshot.sources.shared import held, read_block, write_blocks

# Edits allowed per byte of an item.
RATE = 0.1
# Bytes of items in one file, of texts a task holds while the files pass by, and of text scanned at a time.
BLOCK_BYTES, HELD_BYTES, SCAN_BYTES = 4 << 20, 8 << 20, 1 << 20
BITS = 18
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def normalised(raw: bytes) -> bytes:
    """A-Z in lower case, runs of ASCII white space as one blank, none at the ends."""
    return b" ".join(raw.lower().split())


def budget(size: int, rate: float) -> int:
    """Edits allowed in an item: pieces keep eight bytes where the item has them."""
    return max(0, min(int(rate * size), size // 8 - 1))


def pieces_of(item: bytes, edits: int) -> Iterator[tuple[int, bytes]]:
    """Offset and text of ``edits + 1`` pieces of nearly equal length: ``edits`` edits leave one untouched."""
    cuts = [len(item) * i // (edits + 1) for i in range(edits + 2)]
    for begin, end in zip(cuts, cuts[1:]):
        yield begin, item[begin:end]


def myers(item_masks: dict[int, int], size: int, text: bytes) -> tuple[int, int]:
    """Least edit distance of the item to any substring of the text, and where the first such ends.

    Bit-parallel after Myers: one word of ``size`` bits holds a column of the
    table as differences.
    """
    full = (1 << size) - 1
    top = 1 << (size - 1)
    plus, minus, score = full, 0, size
    best, at = size, 0
    for end, byte in enumerate(text, 1):
        equal = item_masks.get(byte, 0)
        vertical = equal | minus
        horizontal = (((equal & plus) + plus) ^ plus) | equal
        up = minus | (full & ~(horizontal | plus))
        down = plus & horizontal
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up = (up << 1) & full
        down = (down << 1) & full
        plus = down | (full & ~(vertical | up))
        minus = up & vertical
        if score < best:
            best, at = score, end
    return best, at


def _sibling_checks(piece: bytes, sibling: bytes, after: bool) -> list[tuple[int, bytes]]:
    """Places of which one must hold: halves of the sibling that one edit leaves untouched.

    Of an item within its budget some piece is untouched whose sibling (the other
    piece of its pair) has one edit at most: were it otherwise for every pair, the
    edits would be as many as the pieces. An edit in the far half leaves the near
    one in place; an edit in the near half moves the far one by one byte at most.
    """
    if not sibling:
        return []
    half = len(sibling) // 2
    if after:
        near, far, at, beyond = sibling[:half], sibling[half:], len(piece), len(piece) + half
    else:
        near, far, at, beyond = sibling[half:], sibling[:half], half - len(sibling), -len(sibling)
    return [(at, near[:8]), *[(beyond + shift, far[:8]) for shift in (-1, 0, 1)]]


class _Places:
    """For each piece, bytes that must stand at an offset from it."""

    def __init__(self, wanted: list[tuple[int, bytes] | None]):
        self.offset = np.array([w[0] if w else 0 for w in wanted], np.int64)
        self.value = np.array([int.from_bytes(w[1], "little") if w else 0 for w in wanted], np.uint64)
        self.mask = np.array([(1 << 8 * len(w[1])) - 1 if w else 0 for w in wanted], np.uint64)
        self.valid = np.array([w is not None for w in wanted])

    def hold(self, wide: np.ndarray, place: np.ndarray, piece: np.ndarray) -> np.ndarray:
        at = place + self.offset[piece]
        inside = self.valid[piece] & (at >= 0) & (at < len(wide))
        return inside & ((wide[np.where(inside, at, 0)] & self.mask[piece]) == self.value[piece])


class Items:
    """A block of benchmark items with the index of their pieces."""

    def __init__(self, items: list[tuple[int, bytes]], rate: float):
        self.ids = [i for i, _ in items]
        self.texts = [t for _, t in items]
        self.edits = [budget(len(t), rate) for t in self.texts]
        self.masks: list[dict[int, int]] = []
        self.bytes = np.stack([np.bincount(np.frombuffer(t, np.uint8), minlength=256) for t in self.texts])
        self.pieces: list[tuple[int, int, bytes]] = []
        checks: list[list[tuple[int, bytes]]] = []
        for number, (text, edits) in enumerate(zip(self.texts, self.edits)):
            masks: dict[int, int] = {}
            for bit, byte in enumerate(text):
                masks[byte] = masks.get(byte, 0) | 1 << bit
            self.masks.append(masks)
            own = list(pieces_of(text, edits))
            for i, (offset, piece) in enumerate(own):
                self.pieces.append((number, offset, piece))
                sibling = own[i ^ 1][1] if i ^ 1 < len(own) else b""
                checks.append(_sibling_checks(piece, sibling, after=i % 2 == 0))
        self.margin = 3 * max(len(p) for _, _, p in self.pieces) + 16
        self.checks = [_Places([c[k] if k < len(c) else None for c in checks]) for k in range(4)]
        self.has_sibling = np.array([bool(c) for c in checks])
        tails = _Places([(max(0, len(p) - 8), p[-8:]) for _, _, p in self.pieces])
        self.tails = tails
        # By width of the leading bytes that are looked up: their values and the pieces that begin so.
        self.tables = []
        widths = np.array([min(8, len(p)) for _, _, p in self.pieces])
        heads = np.array([int.from_bytes(p[:8], "little") for _, _, p in self.pieces], np.uint64)
        for width in np.unique(widths).tolist():
            own = np.flatnonzero(widths == width)
            own = own[np.argsort(heads[own], kind="stable")]
            values, starts = np.unique(heads[own], return_index=True)
            table = np.zeros(1 << BITS, bool)
            table[(values * _SPREAD) >> np.uint64(64 - BITS)] = True
            self.tables.append((width, values, np.append(starts, len(own)), own, table))

    def hits(self, buffer: np.ndarray) -> Iterator[tuple[int, int, int, bytes]]:
        """Places where a piece stands and its sibling may, with one edit at most."""
        wide = buffer.astype(np.uint64)
        wide[:-1] |= wide[1:] << np.uint64(8)
        wide[:-2] |= wide[2:] << np.uint64(16)
        wide[:-4] |= wide[4:] << np.uint64(32)
        for width, values, starts, own, table in self.tables:
            keys = wide if width == 8 else wide & np.uint64((1 << 8 * width) - 1)
            maybe = np.flatnonzero(table[(keys * _SPREAD) >> np.uint64(64 - BITS)])
            found = np.minimum(np.searchsorted(values, keys[maybe]), len(values) - 1)
            known = values[found] == keys[maybe]
            maybe, found = maybe[known], found[known]
            counts = starts[found + 1] - starts[found]
            place = np.repeat(maybe, counts)
            first = np.repeat(starts[found] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts)
            piece = own[first + np.arange(len(place))]
            stands = self.tails.hold(wide, place, piece)
            place, piece = place[stands], piece[stands]
            beside = ~self.has_sibling[piece]
            for check in self.checks:
                beside |= check.hold(wide, place, piece)
            for at, i in zip(place[beside].tolist(), piece[beside].tolist()):
                yield at, *self.pieces[i]

    def regions(self, text: bytes, spots: list[tuple[int, int]]) -> Iterator[tuple[int, int, int]]:
        """Item and span of text where it may stand; overlapping spans of an item are one."""
        spots.sort()
        current = None
        for number, start in spots:
            edits, size = self.edits[number], len(self.texts[number])
            begin, end = max(0, start - edits), min(len(text), start + size + edits)
            if current and current[0] == number and begin <= current[2]:
                current = number, current[1], max(end, current[2])
                continue
            if current:
                yield current
            current = number, begin, end
        if current:
            yield current

    def verify(self, text: bytes, number: int, begin: int, end: int) -> tuple[int, int] | None:
        """Distance and end of the item's best occurrence in the region, if within its budget."""
        window = text[begin:end]
        there = np.bincount(np.frombuffer(window, np.uint8), minlength=256)
        # Bytes the region lacks altogether cost an edit each.
        if int(np.maximum(self.bytes[number] - there, 0).sum()) > self.edits[number]:
            return None
        distance, at = myers(self.masks[number], len(self.texts[number]), window)
        return (distance, begin + at) if distance <= self.edits[number] else None

    def find(self, texts: list[bytes]) -> Iterator[tuple[int, int, int, int]]:
        """Text number, item id, distance and end of the best occurrence of every item found."""
        starts = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(t) + 1 for t in texts], out=starts[1:])
        joined = np.frombuffer(b"\n".join(texts) + b"\n" + b"\n" * 8, np.uint8)
        spots: dict[int, set[tuple[int, int]]] = {}
        for base in range(0, int(starts[-1]), SCAN_BYTES):
            begin = max(0, base - self.margin)
            for place, number, offset, piece in self.hits(joined[begin : base + SCAN_BYTES + self.margin]):
                place += begin
                if not base <= place < base + SCAN_BYTES:
                    continue
                own = int(np.searchsorted(starts, place, "right")) - 1
                place -= int(starts[own])
                if texts[own].startswith(piece, place):
                    spots.setdefault(own, set()).add((number, place - offset))
        for own, places in spots.items():
            best: dict[int, tuple[int, int]] = {}
            for number, begin, end in self.regions(texts[own], list(places)):
                found = self.verify(texts[own], number, begin, end)
                if found and (number not in best or found < best[number]):
                    best[number] = found
            for number, (distance, end) in best.items():
                yield own, self.ids[number], distance, end


def item_files(benchmark: DataFrame, block_bytes: int) -> list[str]:
    """Items with an id and a text in files of about ``block_bytes`` that tasks read themselves."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text")).distinct()
    rows = fixed(rows.filter("item_id IS NOT NULL AND text IS NOT NULL"))
    size = rows.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    return write_blocks(rows, max(1, -(-size // block_bytes)), "item_id", "items")


def _items_of(file: str, rate: float) -> Items | None:
    """The items of one file; blank ones cannot occur anywhere."""
    table = read_block(file)
    own = [(i, normalised(t.encode())) for i, t in zip(table["item_id"].to_pylist(), table["text"].to_pylist())]
    own = [(i, t) for i, t in own if t]
    return Items(own, rate) if own else None


def find_items(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Items that stand in a document: ``doc_id, _row, item_id, n_edits, end``.

    Text and items are compared as bytes with A-Z in lower case and white space
    collapsed. An item stands in a text when a substring is within
    ``rate`` edits per byte of it (fewer for items of under 16 bytes, none under
    that of 8); ``end`` is where its best occurrence ends in the compared form.
    Each item is cut into one piece more than it has edits, so any occurrence
    holds a piece untouched, beside a piece with one edit at most; the places
    where that may be are verified by Myers' distance. Items stand in files of ``block_bytes``; a task holds a
    stretch of whole texts while the files pass by, so documents are scanned once. Null and empty texts
    hold nothing, null and blank items are nowhere, an empty table of either kind gives an empty result; repeated rows are
    searched each, equal items all reported. A very long text is searched in stretches.
    """
    files = item_files(benchmark, block_bytes)
    schema = "doc_id long, _row long, item_id long, n_edits long, end long"

    @tidy
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only = _items_of(files[0], rate) if len(files) == 1 else None
        for part in held(batches, HELD_BYTES):
            normal = [[normalised(t) for t in as_bytes(batch.column("text"))] for batch in part]
            for file in files:
                items = only if len(files) == 1 else _items_of(file, rate)
                for batch, raw in zip(part, normal):
                    rows = list(items.find(raw)) if items else []
                    if rows:
                        own, ids, edits, ends = zip(*rows)
                        pick = pa.array(own, pa.int64())
                        yield pa.RecordBatch.from_arrays(
                            [batch.column("doc_id").take(pick), batch.column("_row").take(pick)]
                            + [pa.array(c, pa.int64()) for c in (ids, edits, ends)],
                            ["doc_id", "_row", "item_id", "n_edits", "end"],
                        )

    return numbered(docs).mapInArrow(search, schema)


def mark_contaminated(docs: DataFrame, benchmark: DataFrame, rate: float = RATE) -> DataFrame:
    """Per row ``doc_id, contaminated, n_items, item_ids`` (in order) and the least ``n_edits``."""
    docs = settled(docs)
    found = (
        find_items(docs, benchmark, rate)
        .groupBy("_row")
        .agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"), F.min("n_edits").alias("n_edits"))
    )
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("_row"))
    return rows.join(found, "_row", "left").select(
        "doc_id",
        F.col("item_ids").isNotNull().alias("contaminated"),
        F.coalesce(F.size("item_ids"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("item_ids", F.array().cast("array<long>")).alias("item_ids"),
        F.col("n_edits").cast("long").alias("n_edits"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, rate: float = RATE) -> DataFrame:
    """The rows in which no item stands, with all their columns; null and empty texts hold none."""
    docs = settled(docs)
    return listed_rows(docs, row_lists(find_items(docs, benchmark, rate).select("_row").distinct()), keep=False)
