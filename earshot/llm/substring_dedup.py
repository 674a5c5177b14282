"""Deduplication of repeated passages by digests of normalised units."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from earshot.llm.common import numbered, settled
from earshot.session import fixed

# Units: every character of a text is in one of them, white space behind a unit belongs to it.
SENTENCES = r"[^\n.!?。！？]*(?:[.!?。！？]+|\n|\Z)[\x20\x09-\x0D]*"
LINES = r"[^\n]*(?:\n|\Z)"
PARAGRAPHS = r"(?s:.*?)(?:\n[\x20\x09\x0B-\x0D]*\n\s*|\Z)"
# Words a run of repeated units must have together; so many characters count for a word where words are not spaced.
MIN_RUN, WORD_CHARS = 20, 8
# A digest with more than one unit in HOT of all units is settled where it is read: HOT digests at most.
HOT = 1_000
UNIT_SCHEMA = "doc_id long, _row long, digest binary, start long, end long, pos long, words long"
SPAN = "array<struct<start:long,end:long>>"


def _units(text: str, pattern: re.Pattern) -> Iterator[tuple[bytes, int, int, int]]:
    """Digest, span and number of words of each unit that is not blank."""
    for match in pattern.finditer(text):
        words = match.group().encode().lower().split()
        if words:
            joined = b" ".join(words)
            weight = max(len(words), len(joined.decode()) // WORD_CHARS)
            yield hashlib.blake2b(joined, digest_size=16).digest(), match.start(), match.end(), weight


def repeated_units(docs: DataFrame, units: str = SENTENCES, min_run: int = MIN_RUN) -> DataFrame:
    """Units that occur earlier: ``doc_id, _row, start, end`` in characters of the original text.

    Units are compared with A-Z in lower case and white space collapsed; blank ones are none, all
    others are looked at, however short. Of equal ones the earliest by (doc_id, row, start) stays; others are
    returned where they and the repeated units right beside them have ``min_run`` words together, as a single
    short sentence is no evidence of copying (0: all of them). Winners come out of a partial aggregate. The
    most frequent digests are found where units are read, their winners being broadcast; the others are joined.
    """
    compiled = re.compile(units)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = ([], [], [], [], [], [], [])
            ids, numbers = batch.column("doc_id").to_pylist(), batch.column("_row").to_pylist()
            for doc_id, number, text in zip(ids, numbers, batch.column("text").to_pylist()):
                for pos, (digest, start, end, words) in enumerate(_units(text, compiled)):
                    for column, value in zip(rows, (doc_id, number, digest, start, end, pos, words)):
                        column.append(value)
            kinds = [pa.int64(), pa.int64(), pa.binary(), *[pa.int64()] * 4]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(rows, kinds)], ["doc_id", "_row", "digest", "start", "end", "pos", "words"]
            )

    found = fixed(numbered(docs).mapInArrow(run, UNIT_SCHEMA))
    n_units = found.count()
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row", "start")
    winners = fixed(
        found.groupBy("digest").agg(F.min(rank).alias("first"), F.count("*").alias("n")).filter("n > 1")
    )
    hot = F.broadcast(winners.filter(F.col("n") * HOT > n_units).select("digest", "first"))
    cold = winners.filter(F.col("n") * HOT <= n_units).select("digest", "first")
    rest = found.join(hot.select("digest"), "digest", "left_anti").join(cold, "digest")
    met = found.join(hot, "digest").unionByName(rest)
    later = met.filter((F.col("_row") != F.col("first._row")) | (F.col("start") != F.col("first.start")))
    if min_run > 0:
        # Units of one text that stand beside each other have equal distances from their rank.
        place = F.row_number().over(Window.partitionBy("_row").orderBy("pos"))
        beside = later.withColumn("_run", F.col("pos") - place)
        together = F.sum("words").over(Window.partitionBy("_row", "_run"))
        later = beside.withColumn("_words", together).filter(F.col("_words") >= min_run)
    return later.select("doc_id", "_row", "start", "end")


def remove_repeats(docs: DataFrame, units: str = SENTENCES, min_run: int = MIN_RUN) -> DataFrame:
    """Per row ``doc_id, text`` (what is left), ``removed`` (original spans in order) and ``n_chars``.

    Null and empty texts have nothing to remove; repeated rows are documents of
    their own, the first of which keeps its units; ties in doc_id go to the row read first. A text of any length
    is one row, its spans one list. Other columns play no part; an empty table gives an empty result.
    """
    docs = settled(docs)
    spans = fixed(
        repeated_units(docs, units, min_run)
        .groupBy("_row")
        .agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("removed"))
    )
    joined = numbered(docs).join(spans, "_row", "left").select("doc_id", "text", "removed")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, sizes, lists = [], [], []
            for text, removed in zip(batch.column("text").to_pylist(), batch.column("removed").to_pylist()):
                parts, at = [], 0
                for span in removed or []:
                    parts.append(text[at : span["start"]])
                    at = span["end"]
                kept.append("".join(parts) + text[at:])
                sizes.append(len(text))
                lists.append(removed or [])
            spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(kept, pa.string()), pa.array(lists, spans_type), pa.array(sizes, pa.int64())],
                ["doc_id", "text", "removed", "n_chars"],
            )

    return joined.mapInArrow(cut, f"doc_id long, text string, removed {SPAN}, n_chars long")
