"""Word-piece counts by a linear longest-match automaton."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.llm.common import as_bytes, texts

# Words whose counts a task remembers.
MEMORY = 300_000


class Automaton(NamedTuple):
    """Trie of the vocabulary: edges ``state << 8 | byte``, failure links, and pieces popped by following one."""

    edges: np.ndarray
    targets: np.ndarray
    fail: np.ndarray
    popped: np.ndarray


def read_ranks(path: str) -> list[bytes]:
    """Pieces of a rank file: base64 and rank per line."""
    with open(path, "rb") as file:
        return [base64.b64decode(line.split()[0]) for line in file if line.strip()]


def build(pieces: list[bytes]) -> Automaton:
    """Trie, failure links and popped counts, level by level.

    Of a state that is a piece, one piece is popped and matching goes on at the
    root. Of another, what its parent pops is popped, then what is needed until
    the state's last byte can follow. A state with failure -1 cannot be split
    into pieces.
    """
    edges: dict[int, int] = {}
    parent, last, final = [0], [0], [False]
    for piece in pieces:
        state = 0
        for byte in piece:
            key = state << 8 | byte
            following = edges.get(key)
            if following is None:
                following = edges[key] = len(parent)
                parent.append(state)
                last.append(byte)
                final.append(False)
            state = following
        if state:
            final[state] = True
    depth = [0] * len(parent)
    for state in range(1, len(parent)):
        depth[state] = depth[parent[state]] + 1
    fail, popped = [-1] * len(parent), [0] * len(parent)
    for state in sorted(range(1, len(parent)), key=depth.__getitem__):
        if final[state]:
            fail[state], popped[state] = 0, 1
            continue
        link, count = fail[parent[state]], popped[parent[state]]
        while link >= 0 and link << 8 | last[state] not in edges:
            count += popped[link]
            link = fail[link]
        if link >= 0:
            fail[state], popped[state] = edges[link << 8 | last[state]], count
    return Automaton(
        np.fromiter(edges.keys(), np.int64, len(edges)),
        np.fromiter(edges.values(), np.int32, len(edges)),
        np.array(fail, np.int32),
        np.array(popped, np.int32),
    )


class Counter:
    """Counts the pieces of words; every byte is read once."""

    def __init__(self, automaton: Automaton):
        self.edges = dict(zip(automaton.edges.tolist(), automaton.targets.tolist()))
        self.fail = automaton.fail.tolist()
        self.popped = automaton.popped.tolist()
        self.known: dict[bytes, int] = {}

    def word(self, word: bytes) -> int:
        """Pieces of the greedy longest-match split; 0 where there is none."""
        edges, fail, popped = self.edges, self.fail, self.popped
        state = count = 0
        for byte in word:
            following = edges.get(state << 8 | byte)
            while following is None:
                count += popped[state]
                state = fail[state]
                if state < 0 or (state == 0 and byte not in edges):
                    return 0
                following = edges.get(state << 8 | byte)
            state = following
        while state:
            count += popped[state]
            state = fail[state]
            if state < 0:
                return 0
        return count

    def text(self, text: bytes) -> tuple[int, int, int]:
        """Words, pieces (one for a word that cannot be split) and words without a split."""
        words = text.split()
        known = self.known
        if len(known) > MEMORY:
            known.clear()
        pieces = unknown = 0
        for word in words:
            count = known.get(word)
            if count is None:
                count = known[word] = self.word(b" " + word)
            pieces += count or 1
            unknown += not count
        return len(words), pieces, unknown


def count_pieces(docs: DataFrame, automaton: Automaton) -> DataFrame:
    """Per row ``doc_id, n_bytes, n_words, n_pieces, n_unknown`` of the whole text.

    A word is a run without ASCII white space, matched with one blank before
    it. A word that cannot be split counts as one unknown piece. Null and empty
    texts have no words; repeated rows are counted one by one; other columns
    play no part; an empty table gives an empty result. A text of any length is one
    pass over its words. The automaton is bounded by the vocabulary.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tuple(automaton))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(Automaton(*shared.value))
        for batch in batches:
            raw = as_bytes(batch.column("text"))
            counts = [counter.text(text) for text in raw]
            columns = [[c[i] for c in counts] for i in range(3)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(t) for t in raw], pa.int64())]
                + [pa.array(c, pa.int64()) for c in columns],
                ["doc_id", "n_bytes", "n_words", "n_pieces", "n_unknown"],
            )

    schema = "doc_id long, n_bytes long, n_words long, n_pieces long, n_unknown long"
    return texts(docs).mapInArrow(run, schema)
