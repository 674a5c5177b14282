"""Alignment of two tokenizers' tokens by lockstep merging of their ends."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.llm.common import as_bytes, slices, texts
from earshot.session import fixed

# Bytes of text one state vector walks through together, and bytes of one lane of it.
BATCH_BYTES, LANE = 1 << 20, 1 << 10
# Byte-level pairs cut text by this rule before they merge.
BYTE_LEVEL_RULE = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Characters by which byte-level vocabularies write bytes: printable ones stand for themselves.
_PRINTABLE = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
_BYTE_OF = {chr(b): b for b in _PRINTABLE} | {
    chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(_PRINTABLE))
}
# A pair of ids as one number.
_PAIR = 1 << 32
LINKS = (("pairs", np.int64), ("times", np.int32))
ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, pairs binary, times binary, groups_sha256 string"


def byte_level_vocabulary(path: str) -> list[bytes]:
    """Bytes of each id of a byte-level BPE file without normalizer whose merges stand in the order of their ids."""
    with open(path, "rb") as file:
        steps = json.loads(file.read())
    model, cut = steps["model"], steps["pre_tokenizer"]
    vocabulary = model["vocab"]
    added = {t["content"] for t in steps["added_tokens"]}
    plain = sorted((i, t) for t, i in vocabulary.items() if t not in added)
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    ordered = [vocabulary["".join(pair)] for pair in pairs] == [i for i, _ in plain[256:]]
    whole = cut["type"] == "ByteLevel" and cut["use_regex"] and not cut["add_prefix_space"]
    if not (whole and ordered and steps["normalizer"] is None and [i for i, _ in plain] == list(range(len(plain)))):
        raise ValueError("not a plain byte-level vocabulary")
    return [bytes(_BYTE_OF[c] for c in token) for _, token in plain]


def _piece_bytes(pieces) -> list[bytes]:
    """Bytes of each id of a sentence-piece model; U+2581 is a space, byte pieces are their byte."""
    return [
        bytes([int(pieces.id_to_piece(i)[3:5], 16)])
        if pieces.is_byte(i)
        else pieces.id_to_piece(i).replace("▁", " ").encode()
        for i in range(pieces.get_piece_size())
    ]


class Decimals:
    """Decimal numbers of ids with a sign behind each, written for many ids at once."""

    def __init__(self, size: int):
        width = len(str(size))
        self.digits = np.zeros((size, width + 1), np.uint8)
        text = np.char.mod("%d", np.arange(size)).astype(f"S{width}")
        self.digits[:, :width] = text.view(np.uint8).reshape(size, width)
        self.width = np.char.str_len(text).astype(np.int64)

    def write(self, ids: np.ndarray, signs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All numbers and signs in a row, and where each number's sign ends."""
        widths = self.width[ids]
        rows = self.digits[ids]
        rows[np.arange(len(ids)), widths] = signs
        return rows[np.arange(rows.shape[1]) <= widths[:, None]], np.cumsum(widths + 1)


def common_ends(a_ends: np.ndarray, b_ends: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in both lists of the ends they share, by merging all lanes in lockstep.

    ``stops`` are the lanes' last bytes; whether two tokens end together does not depend
    on others, so a lane may begin anywhere. One step looks at one token of
    either side in every lane, links those that end together and moves on from the
    nearer end; lanes that are through leave the vectors.
    """
    a_cuts, b_cuts = (np.searchsorted(ends, stops, "right") for ends in (a_ends, b_ends))
    a_at, b_at = np.concatenate(([0], a_cuts[:-1])), np.concatenate(([0], b_cuts[:-1]))
    met_a, met_b = [], []
    while True:
        running = (a_at < a_cuts) & (b_at < b_cuts)
        if not running.all():
            a_at, b_at, a_cuts, b_cuts = a_at[running], b_at[running], a_cuts[running], b_cuts[running]
        if not len(a_at):
            break
        left, right = a_ends[a_at], b_ends[b_at]
        together = left == right
        met_a.append(a_at[together])
        met_b.append(b_at[together])
        a_at = a_at + (left <= right)
        b_at = b_at + (right <= left)
    if not met_a:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    a, b = np.concatenate(met_a), np.concatenate(met_b)
    order = np.argsort(a, kind="stable")
    return a[order], b[order]


class Aligner:
    """Both tokenizers with the bytes of their ids; tokenizes and aligns slices of texts."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        import tiktoken

        entries = byte_level_vocabulary(a_path)
        ranks = {entry: i for i, entry in enumerate(entries)}
        self.a = tiktoken.Encoding("a", pat_str=BYTE_LEVEL_RULE, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.a_bytes, self.b_bytes = entries, _piece_bytes(self.b)
        self.a_sizes = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_sizes = np.array([len(x) for x in self.b_bytes], np.int64)
        self.decimals = Decimals(max(len(self.a_bytes), len(self.b_bytes)))

    def align(self, raw: list[bytes]) -> list[tuple[int, int, int, bytes, bytes, str]]:
        """Per text its numbers of tokens of both sides and of groups, its linked pairs, how often each is, and the digest of its groups."""
        out: list[tuple[int, int, int, bytes, bytes, str]] = [(0, 0, 0, b"", b"", "")] * len(raw)
        lists_a, lists_b, whole = [], [], []
        decoded = [text.decode() for text in raw]
        for i, b_ids in enumerate(self.b.encode(decoded, num_threads=1)):
            target = b" " + raw[i]
            if raw[i] and b"".join(map(self.b_bytes.__getitem__, b_ids)) == target:
                a_ids = self.a.encode_to_numpy(" " + decoded[i], disallowed_special=())
                if b"".join(map(self.a_bytes.__getitem__, a_ids.tolist())) == target:
                    lists_a.append(a_ids.astype(np.int64))
                    lists_b.append(np.array(b_ids, np.int64))
                    whole.append(i)
        if not whole:
            return out
        a_ids, b_ids = np.concatenate(lists_a), np.concatenate(lists_b)
        a_ends, b_ends = np.cumsum(self.a_sizes[a_ids]), np.cumsum(self.b_sizes[b_ids])
        sizes = np.array([len(raw[i]) + 1 for i in whole])
        doc_ends = np.cumsum(sizes)
        stops = np.unique(np.concatenate((np.arange(LANE, doc_ends[-1], LANE), doc_ends)))
        a_at, b_at = common_ends(a_ends, b_ends, stops)
        cuts = a_ends[a_at]
        # A token's group is the number of cuts before its end; a group is its A side, then its B side.
        a_group, b_group = np.searchsorted(cuts, a_ends), np.searchsorted(cuts, b_ends)
        place_a = np.arange(len(a_ids)) + np.searchsorted(b_group, a_group)
        place_b = np.arange(len(b_ids)) + np.searchsorted(a_group, b_group, "right")
        ids = np.empty(len(a_ids) + len(b_ids), np.int64)
        ids[place_a], ids[place_b] = a_ids, b_ids
        signs = np.full(len(ids), ord(","), np.uint8)
        signs[place_a[a_at]], signs[place_b[b_at]] = ord("|"), ord(";")
        written, ends = self.decimals.write(ids, signs)
        data = written.tobytes()
        pairs = a_ids[a_at] * _PAIR + b_ids[b_at]
        edges = [np.searchsorted(places, doc_ends, "right").tolist() for places in (a_ends, b_ends, cuts)]
        a_first, b_first, l_first, begin = 0, 0, 0, 0
        for i, a_last, b_last, l_last in zip(whole, *edges):
            end = int(ends[a_last + b_last - 1])
            digest = hashlib.sha256(data[begin : end - 1]).hexdigest()
            own, times = np.unique(pairs[l_first:l_last], return_counts=True)
            out[i] = (a_last - a_first, b_last - b_first, l_last - l_first, own.tobytes(), times.astype(np.int32).tobytes(), digest)
            a_first, b_first, l_first, begin = a_last, b_last, l_last, end
        return out



def _aligned(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(a_path, b_path)
        for batch in batches:
            raw = as_bytes(batch.column("text"))
            for first, part in slices(raw, BATCH_BYTES):
                n_a, n_b, n_groups, pairs, times, digests = zip(*aligner.align(part))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(first, len(part)),
                        *[pa.array(c, pa.int64()) for c in (n_a, n_b, n_groups)],
                        *[pa.array(c, pa.binary()) for c in (pairs, times)],
                        pa.array(digests, pa.string()),
                    ],
                    ["doc_id", "n_a", "n_b", "n_groups", "pairs", "times", "groups_sha256"],
                )

    return texts(docs).mapInArrow(run, ALIGNED)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``pair, n, best``: how many links hold an id pair, and whether no pair of its B id has more.

    Tasks count their links before they are shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            new, n_new = (np.frombuffer(b"".join(batch.column(c).to_pylist()), k) for c, k in LINKS)
            pairs, places = np.unique(np.concatenate((pairs, new)), return_inverse=True)
            counts = np.bincount(places, np.concatenate((counts, n_new)), len(pairs)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(counts)], ["pair", "n"])

    summed = (
        aligned.select("pairs", "times").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    )
    summed = fixed(summed.withColumn("b_id", F.col("pair") % _PAIR))
    most = summed.groupBy("b_id").agg(F.max("n").alias("most"))
    return summed.join(most, "b_id").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def align(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Per row ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, pairs, times``.

    Side A is a byte-level BPE file and reads a space and the text, side B is a sentence-piece model that
    adds the space itself. Tokens of both that end at the same byte are linked and cut the text into groups.
    ``pairs`` are the linked ids (A id times 2**32, plus B id, as sorted 64-bit numbers), ``times`` how many
    links of the row hold each (32-bit numbers).
    ``n_best`` counts links whose pair is the most frequent one of its B id in all
    texts, ties included; ``count_sum`` adds the frequencies of the links' pairs. Null and empty texts, and those
    whose tokens do not give back their bytes, have no tokens: zeros and an empty digest. Repeated
    rows are rows of their own; other columns play no part; an empty table gives an empty result. Whole texts
    are tokenized, however long; memory grows with the longest.

    Of two tokens that end together the shorter is the end of the longer, so all pairs there can be
    are no more than twice the bytes of both vocabularies together, whatever the corpus: the
    table of their counts is broadcast.
    """
    spark = docs.sparkSession
    aligned = fixed(_aligned(docs, a_path, b_path))
    counts = pair_counts(aligned).toArrow().sort_by("pair")
    shared = spark.sparkContext.broadcast(
        tuple(counts.column(c).to_numpy() for c in ("pair", "n", "best")) if len(counts) else None
    )

    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "pairs", "times"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = np.array([len(x) // 8 for x in batch.column("pairs").to_pylist()], np.int64)
            at = np.concatenate(([0], np.cumsum(lengths)))
            sums = [np.zeros(len(lengths), np.int64)] * 3
            if at[-1]:
                pairs, n, best = shared.value
                own, times = (np.frombuffer(b"".join(batch.column(c).to_pylist()), k) for c, k in LINKS)
                found = np.searchsorted(pairs, own)
                each = (times, times * best[found], times * n[found])
                running = [np.concatenate(([0], np.cumsum(x.astype(np.int64)))) for x in each]
                sums = [s[at[1:]] - s[at[:-1]] for s in running]
            values = dict(zip(("n_links", "n_best", "count_sum"), map(pa.array, sums)))
            yield pa.RecordBatch.from_arrays([values[c] if c in values else batch.column(c) for c in columns], columns)

    schema = (
        "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
        "groups_sha256 string, pairs binary, times binary"
    )
    return aligned.mapInArrow(run, schema)
