"""Keyword search over stored posting lists of character grams."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.functions.once import let
from earshot.session import fixed, scratch_path, scratch_removed
from earshot.sources import keyed
from earshot.sources.shared import held as held_batches
from earshot.sources.shared import read_block, write_blocks

# Characters of a gram, and texts and characters of a block: a posting list is cut by blocks, so the longest one is a
# short row, and names a text by its place in the block, a small number.
GRAM, BLOCK_TEXTS, BLOCK_CHARS = 3, 4096, 4 << 20
# Words that are looked for in a block at a time, and lists that are turned into bits at a time.
WORDS_TOGETHER, ROWS_TOGETHER = 2048, 1024
# Characters in which a part's words are looked for at a time, and texts they may be of.
STRETCH, TEXTS_TOGETHER = 1 << 17, 1024
# Entries in the tables of a part's first steps (further ones, which few places reach, are searched), and parts whose
# tables a task keeps.
TABLE, TREES = 1 << 19, 8
# Bits of a character in the number of a gram; characters count from one, so a shorter gram ends in zeros.
_BITS = 21
_BLOCKS = "gram string, block bigint, texts array<smallint>, ids array<bigint>"


def _grams(text: Column, sizes: range) -> Column:
    """The distinct pieces of these sizes."""

    def of_size(chars: Column, size: int) -> Column:
        places = F.sequence(F.lit(0), F.size(chars) - size)
        found = F.transform(places, lambda i: F.concat(*[F.get(chars, i + n) for n in range(size)]))
        return F.when(F.size(chars) >= size, found).otherwise(F.array().cast("array<string>"))

    def pieces(chars: Column) -> Column:
        return F.array_distinct(F.concat(*[of_size(chars, size) for size in sizes]))

    return let(F.split(text, ""), pieces)


def searched_texts(episodes: DataFrame, transcripts: DataFrame) -> DataFrame:
    """Titles and transcripts in lower case: ``text_id, episode_key, in_title, text``."""
    low = lambda df, column, title: df.select(
        F.col("episode_id").cast("string").alias("episode_key"), F.lower(column).alias("text"), F.lit(title).alias("in_title")
    )
    both = low(episodes, "episode_title", True).unionByName(low(transcripts, "transcript_text", False))
    return both.filter("text <> ''").withColumn("text_id", F.xxhash64("episode_key", "in_title"))


def _block_lists(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The grams of some texts; where the list of each begins, and an end; and the lists, one after the other."""
    numbers, places = [], []
    for place, text in enumerate(texts):
        chars = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.int64) + 1
        found, sizes = chars << (GRAM - 1) * _BITS, [chars << (GRAM - 1) * _BITS]
        for n in range(1, min(GRAM, len(chars))):
            found = found[:-1] | (chars[n:] << (GRAM - 1 - n) * _BITS)
            sizes.append(found)
        numbers.append(np.unique(np.concatenate(sizes)))
        places.append(np.full(len(numbers[-1]), place, np.int16))
    number, place = np.concatenate(numbers), np.concatenate(places)
    order = np.argsort(number, kind="stable")
    number, place = number[order], place[order]
    starts = np.flatnonzero(np.r_[True, np.diff(number) != 0])
    shifts = np.arange(GRAM - 1, -1, -1) * _BITS
    chars = (number[starts][:, None] >> shifts) & ((1 << _BITS) - 1)
    words = np.ascontiguousarray(np.maximum(chars - 1, 0).astype("<u4")).view(f"<U{GRAM}").ravel().tolist()
    grams = [word.ljust(n, "\0") for word, n in zip(words, (chars > 0).sum(axis=1).tolist())]
    return grams, np.append(starts, len(place)), place


def _in_blocks(texts: DataFrame) -> DataFrame:
    """The lists of blocks of texts as they are scanned, and which texts (``ids``) a block is made of."""
    most_texts, most_chars = BLOCK_TEXTS, BLOCK_CHARS
    names = [piece.split()[0] for piece in _BLOCKS.split(", ")]
    types = [pa.string(), pa.int64(), pa.list_(pa.int16()), pa.list_(pa.int64())]

    def rows(*columns: pa.Array | None) -> pa.RecordBatch:
        size = next(len(c) for c in columns if c is not None)
        filled = [pa.nulls(size, t) if c is None else c for c, t in zip(columns, types)]
        return pa.RecordBatch.from_arrays(filled, names)

    def block_of(number: int, ids: list[int], texts: list[str]) -> Iterator[pa.RecordBatch]:
        grams, starts, places = _block_lists(texts)
        yield rows(None, pa.array([number], pa.int64()), None, pa.array([ids], types[3]))
        lists = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(places, pa.int16()))
        blocks = pa.array(np.full(len(grams), number), pa.int64())
        yield rows(pa.array(grams, pa.string()), blocks, lists, None)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, ids, held, chars = TaskContext.get().partitionId() << 32, [], [], 0
        for batch in batches:
            for text_id, text in zip(batch.column("text_id"), batch.column("text")):
                text = text.as_py()
                if held and (len(held) >= most_texts or chars + len(text) > most_chars):
                    yield from block_of(number, ids, held)
                    number, ids, held, chars = number + 1, [], [], 0
                ids.append(text_id.as_py())
                held.append(text)
                chars += len(text)
        if held:
            yield from block_of(number, ids, held)

    return texts.select("text_id", "text").mapInArrow(cut, _BLOCKS)


def store_postings(texts: DataFrame, path: str) -> keyed.Written:
    """Store which texts hold each gram of one to three characters: ``gram, block, texts``.

    A list is one row per block of texts, so a gram that every text has is as many rows as there are blocks; ``texts`` are
    places in the block. The ids of a block's texts stand beside the lists, once.
    """
    with scratch_removed(texts.sparkSession):
        found = fixed(_in_blocks(texts))
        found.filter("ids IS NOT NULL").select("block", "ids").write.mode("overwrite").parquet(f"{path}/blocks")
        lists = found.filter("ids IS NULL").select("gram", "block", "texts")
        return keyed.store(lists, path, ["gram"], "block")


def _in_texts(lists: pa.Table, texts: int, grams: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Places of texts that hold all grams of a word, and the word's number, by place."""
    where = pc.index_in(grams.flatten(), lists["gram"].combine_chunks())
    sizes, rows = grams.value_lengths().to_numpy(), where.fill_null(-1).to_numpy()
    starts = np.append(0, np.cumsum(sizes)[:-1])
    known = np.flatnonzero(np.minimum.reduceat(rows, starts) >= 0)
    rows = rows[np.repeat(np.isin(np.arange(len(sizes)), known), sizes)]
    if not len(rows):
        return np.zeros(0, np.int64), known
    used, row = np.unique(rows, return_inverse=True)
    holders = lists["texts"].combine_chunks().take(pa.array(used))
    held = np.zeros((len(used), -(-texts // 8)), np.uint8)
    for first in range(0, len(used), ROWS_TOGETHER):
        part = holders.slice(first, ROWS_TOGETHER)
        flags = np.zeros((len(part), texts), bool)
        flags[np.repeat(np.arange(len(part)), part.value_lengths().to_numpy()), part.flatten().to_numpy()] = True
        held[first : first + len(part)] = np.packbits(flags, axis=1)
    all_of = np.bitwise_and.reduceat(held[row], np.append(0, np.cumsum(sizes[known])[:-1]), axis=0)
    place, word = np.nonzero(np.unpackbits(all_of, axis=1, count=texts).T)
    return place, known[word]


class _Level(NamedTuple):
    """Steps by one character: ``keys`` are ``state * alphabet + character``, a key's place is the state it leads to.

    ``table`` is the same, by key (-1 for no step), where there is room; ``words`` has the word that ends in a state, or -1.
    """

    keys: np.ndarray
    table: np.ndarray | None
    words: np.ndarray

    def step(self, state: np.ndarray, radix: int, char: np.ndarray) -> np.ndarray:
        if self.table is not None:
            return self.table[state * np.int32(radix) + char]
        key = state.astype(np.int64) * radix + char
        place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[place] == key, place, -1).astype(np.int32)


class _Tree(NamedTuple):
    """Words by their beginnings; characters are numbered from one, zero stands for those of no word."""

    numbers: np.ndarray
    levels: list[_Level]


def _points(texts: list[str]) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("utf-32-le"), "<u4")


def _tree(words: list[str]) -> _Tree:
    sizes = np.array([len(word) for word in words], np.int64)
    points = _points(words).astype(np.int64)
    alphabet = np.unique(points)
    numbers = np.zeros(int(points.max(initial=0)) + 2, np.int32)
    numbers[alphabet] = np.arange(1, len(alphabet) + 1)
    chars, starts, radix = numbers[points], np.cumsum(sizes) - sizes, len(alphabet) + 1
    levels, states, size, room = [], np.zeros(len(words), np.int64), 1, TABLE
    for depth in range(int(sizes.max(initial=0))):
        longer = np.flatnonzero(sizes > depth)
        keys, states[longer] = np.unique(states[longer] * radix + chars[starts[longer] + depth], return_inverse=True)
        ends = longer[sizes[longer] == depth + 1]
        final = np.full(len(keys), -1, np.int32)
        final[states[ends]] = ends
        table = None
        if size * radix <= room:
            room -= size * radix
            table = np.full(size * radix, -1, np.int32)
            table[keys] = np.arange(len(keys))
        levels.append(_Level(keys, table, final))
        size = len(keys)
    return _Tree(numbers, levels)


def _contained(tree: _Tree, texts: list[str], words: int) -> np.ndarray:
    """Which texts contain which words, as flags ``texts x words``.

    From every character the tree is followed as far as the text goes with it, all characters of a stretch together; a text
    of any length is some stretches.
    """
    found = np.zeros((len(texts), words), bool)
    sizes = np.array([len(text) + 1 for text in texts], np.int64)
    # A text ends with a character of no word, and so many follow the last that no step leaves the array.
    points = np.minimum(_points([text + "\0" for text in texts]), len(tree.numbers) - 1)
    chars = np.append(tree.numbers[points], np.zeros(len(tree.levels), np.int32))
    chars[np.cumsum(sizes) - 1] = 0
    owner, radix = np.repeat(np.arange(len(texts), dtype=np.int32), sizes), int(tree.numbers.max(initial=0)) + 1
    for first in range(0, len(points), STRETCH):
        place = np.arange(first, min(first + STRETCH, len(points)))
        state = np.zeros(len(place), np.int32)
        for depth, level in enumerate(tree.levels):
            state = level.step(state, radix, chars[place + depth])
            on = np.flatnonzero(state >= 0)
            place, state = place[on], state[on]
            if not len(place):
                break
            word = level.words[state]
            ends = np.flatnonzero(word >= 0)
            found[owner[place[ends]], word[ends]] = True
    return found


def _stretches(texts: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """A column's texts in pieces that are searched together, and where each begins."""
    first, kept, chars = 0, [], 0
    for place, text in enumerate(texts):
        text = text.as_py()
        if kept and (chars + len(text) > STRETCH or len(kept) >= TEXTS_TOGETHER):
            yield first, kept
            first, kept, chars = place, [], 0
        kept.append(text)
        chars += len(text)
    if kept:
        yield first, kept


def _verified(found: DataFrame, parts: DataFrame) -> DataFrame:
    """Of ``numbers`` in each row (with ``text_id, part``), those of words that the row's text does contain.

    ``found`` has ``episode_key, in_title, text, asked``, the last an array of ``part, numbers``; the result has
    ``episode_key, in_title, part, numbers`` where a word is left.
    """
    files = write_blocks(parts, parts.count() or 1, "part", "verified")
    schema = pa.schema(
        [("episode_key", pa.string()), ("in_title", pa.bool_()), ("part", pa.int32()), ("numbers", pa.list_(pa.int16()))]
    )

    def in_batch(batch: pa.RecordBatch, part: int, tree: _Tree, words: int, asked: np.ndarray) -> pa.RecordBatch:
        lists = batch.column("asked").flatten()
        of_part = np.flatnonzero(lists.field("part").to_numpy() == part)
        rows, numbers = asked[of_part], lists.field("numbers").take(pa.array(of_part))
        sizes = numbers.value_lengths().to_numpy()
        number, place = numbers.flatten().to_numpy(), np.repeat(np.arange(len(rows)), sizes)
        used, text = np.unique(rows, return_inverse=True)
        keep, ends = np.zeros(len(number), bool), np.append(0, np.cumsum(sizes))
        for first, texts in _stretches(batch.column("text").take(pa.array(used))):
            own = slice(*ends[np.searchsorted(text, [first, first + len(texts)])])
            keep[own] = _contained(tree, texts, words)[text[place[own]] - first, number[own]]
        own, starts = np.unique(place[keep], return_index=True)
        left = pa.ListArray.from_arrays(pa.array(np.append(starts, keep.sum()), pa.int32()), pa.array(number[keep], pa.int16()))
        row = pa.array(rows[own])
        keys = [batch.column(name).take(row) for name in ("episode_key", "in_title")]
        return pa.RecordBatch.from_arrays([*keys, pa.array(np.full(len(own), part, np.int32)), left], schema=schema)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = {}
        for file in files:
            table = read_block(file)
            words |= dict(zip(table["part"].to_pylist(), table["words"].combine_chunks()))
        tree = lru_cache(TREES)(lambda part: _tree(words[part].as_py()))
        for few in held_batches(batches):
            for batch in pa.Table.from_batches(few).combine_chunks().to_batches():
                asked = np.repeat(np.arange(len(batch)), batch.column("asked").value_lengths().to_numpy())
                for part in pc.unique(batch.column("asked").flatten().field("part")).to_pylist():
                    yield in_batch(batch, part, tree(part), len(words[part]), asked)

    columns = "episode_key string, in_title boolean, part int, numbers array<smallint>"
    return found.select("episode_key", "in_title", "text", "asked").mapInArrow(verify, columns)


def _parts(words: DataFrame) -> DataFrame:
    """The distinct words in parts that are searched together: ``part, words``; a word's number is its place in its part."""
    distinct = fixed(words.select("word").distinct())
    parts = -(-distinct.count() // WORDS_TOGETHER) or 1
    part = F.pmod(F.xxhash64("word"), F.lit(parts)).cast("int").alias("part")
    return fixed(distinct.groupBy(part).agg(F.collect_list("word").alias("words")))


def _candidates(parts: DataFrame, path: str) -> DataFrame:
    """``text_id, part, numbers`` of the words that a text may contain, since it holds all grams of theirs.

    Lists meet by block, in bits a text; the words stand in files that the tasks read, so a gram's list is moved once
    however many words ask for it.
    """
    spark = parts.sparkSession
    of_word = lambda word: F.when(F.length(word) < GRAM, F.array(word)).otherwise(_grams(word, range(GRAM, GRAM + 1)))
    asked = fixed(parts.select("part", F.posexplode("words").alias("number", "word"))).select(
        "part", "number", of_word(F.col("word")).alias("grams")
    )
    grams = fixed(asked.select(F.explode("grams").alias("gram")).distinct())
    lists = keyed.read_buckets_of(grams, path, ["gram"]).join(grams, "gram", "left_semi")
    files = write_blocks(asked, parts.count() or 1, "part", "words")
    texts = spark.read.schema("block bigint, ids array<bigint>").parquet(f"{path}/blocks")
    schema = pa.schema([("text_id", pa.int64()), ("part", pa.int32()), ("numbers", pa.list_(pa.int16()))])

    def in_block(lists: pa.Table, texts: pa.Table) -> pa.Table:
        found = [schema.empty_table()]
        ids = texts["ids"].combine_chunks().flatten()
        for file in files if len(lists) else ():
            asked = read_block(file)
            for part in asked["part"].unique():
                words = asked.filter(pc.equal(asked["part"], part))
                place, word = _in_texts(lists, len(ids), words["grams"].combine_chunks())
                own, starts = np.unique(place, return_index=True)
                numbers = words["number"].to_numpy()[word].astype(np.int16)
                held = pa.ListArray.from_arrays(pa.array(np.append(starts, len(place)), pa.int32()), pa.array(numbers))
                same = pa.array(np.full(len(own), part.as_py()), pa.int32())
                found.append(pa.Table.from_arrays([ids.take(pa.array(own)), same, held], schema=schema))
        return pa.concat_tables(found)

    columns = "text_id bigint, part int, numbers array<smallint>"
    return lists.groupBy("block").cogroup(texts.groupBy("block")).applyInArrow(in_block, columns)


def keyword_search(
    keywords: DataFrame, episodes: DataFrame, transcripts: DataFrame, postings: str | None = None
) -> DataFrame:
    """Episodes whose title or transcript contains a keyword, in any case.

    ``keywords`` has ``query_id, keyword``; every character of a keyword is literal, and null or
    empty ones find nothing. The lists of a keyword's grams are intersected, and what is in all
    of them is verified on the text, all words of a text at once. ``postings`` is what ``store_postings`` wrote of the same texts; without it they
    are indexed first.
    """
    spark = keywords.sparkSession
    texts = searched_texts(episodes, transcripts)
    if postings is None:
        postings = scratch_path(spark, "postings")
        store_postings(texts, postings)
    asked = fixed(
        keywords.filter("keyword <> ''").select(
            F.col("query_id").cast("bigint").alias("query_id"), F.lower("keyword").alias("word")
        )
    )
    parts = _parts(asked)
    # Words stay numbers, together in one row per text and then per episode, until the names are there.
    found = _candidates(parts, postings).groupBy("text_id").agg(F.collect_list(F.struct("part", "numbers")).alias("asked"))
    contained = _verified(found.join(texts, "text_id"), parts)
    numbers_of = lambda rows: F.flatten(F.collect_list(F.when(rows, F.col("numbers"))))
    matched = (
        contained.filter(F.size("numbers") > 0)
        .groupBy("episode_key", "part")
        .agg(numbers_of(F.col("in_title")).alias("title"), numbers_of(~F.col("in_title")).alias("transcript"))
    )
    names = episodes.select("episode_id", "episode_title", F.col("episode_id").cast("string").alias("episode_key"))
    marked = lambda numbers, title, transcript: F.transform(
        numbers, lambda n: F.struct(n.alias("number"), F.lit(title).alias("in_title"), F.lit(transcript).alias("in_transcript"))
    )
    each = F.concat(
        marked(F.array_intersect("title", "transcript"), True, True),
        marked(F.array_except("title", "transcript"), True, False),
        marked(F.array_except("transcript", "title"), False, True),
    )
    hits = matched.join(names, "episode_key").select("part", "episode_id", "episode_title", F.inline(each))
    numbered = parts.select("part", F.posexplode("words").alias("number", "word")).join(asked, "word")
    queries = fixed(numbered.select("part", F.col("number").cast("smallint").alias("number"), "query_id"))
    return hits.join(queries, ["part", "number"]).select(
        "query_id", "episode_id", "episode_title", "in_title", "in_transcript"
    )
