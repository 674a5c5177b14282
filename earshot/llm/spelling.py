"""Spelling variants of words, found over an index of grams of variable length."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.llm.common import texts
from earshot.session import fixed

LETTERS = "[A-Za-zÀ-ÿ]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Shortest and longest gram. The longest may not exceed the shortest word, or an edit could spoil all its grams.
SHORTEST, LONGEST = 2, 5
# Grams the dictionary holds at most; the number fixes the frequency from which a gram is extended.
DICTIONARY = 200_000
# Words of a list that one task compares with each other; longer lists are cut.
LIST_BLOCK = 4_000
# Signs before and behind a word.
_BEGIN, _END = "\x02", "\x03"


def word_counts(docs: DataFrame, min_chars: int = 5, min_count: int = 3, slips: int | None = None) -> DataFrame:
    """``word, n``: words of at least ``min_chars`` code points met at least ``min_count`` times.

    Words are runs of Latin letters with A-Z in lower case, out of whole texts (null:
    none). With ``slips`` one letter of every ``slips``-th (document, word) is left out, by a checksum,
    so that a corpus holds misspellings to find. A row without an id counts like one whose id is
    empty. A word in all documents is counted in every task first.
    """
    found = texts(docs).select(
        "doc_id", F.explode(F.regexp_extract_all("text", F.lit(LETTERS), F.lit(0))).alias("run")
    )
    found = found.withColumn("run", F.translate("run", _UPPER, _LOWER))
    if slips is None:
        words = found.select(F.col("run").alias("word"))
    else:
        drawn = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run")))
        place = (drawn % F.length("run")).cast("int")
        short = F.concat(F.substring("run", F.lit(1), place), F.substring("run", place + 2, F.length("run")))
        words = found.select(F.when(drawn % slips == 0, short).otherwise(F.col("run")).alias("word"))
    counted = words.filter(F.length("word") >= min_chars).groupBy("word").agg(F.count("*").alias("n"))
    return counted.filter(F.col("n") >= min_count)


def gram_dictionary(words: DataFrame, size: int = DICTIONARY) -> set[str]:
    """Grams so frequent that longer ones take their place: at most ``size``.

    All places of all words together hold a number of grams of one length, so no more than
    that number over ``least`` of them can occur more than ``least`` times. A gram occurs at least as often as
    its extensions: the set is a trie, cut where a gram is rare enough.
    """
    lengths = list(range(SHORTEST, LONGEST))
    marked = F.concat(F.lit(_BEGIN), "word", F.lit(_END))
    places = words.agg(F.coalesce(F.sum(F.length("word") + 1), F.lit(0))).head()[0]
    least = max(1, math.ceil(len(lengths) * places / size))
    every = words.select(marked.alias("m")).select("m", F.explode(F.sequence(F.lit(1), F.length("m") - 1)).alias("at"))
    grams = every.select(F.explode(F.array(*[F.substring("m", F.col("at"), F.lit(k)) for k in lengths])).alias("gram"))
    often = grams.groupBy("gram").count().filter(F.col("count") > least)
    return {r[0] for r in often.select("gram").toLocalIterator()}


def decompose(word: str, often: set[str]) -> tuple[list[str], int]:
    """A word's gram at every place, and how many of them one edit can spoil.

    The gram is the shortest piece from the place on that the dictionary does not
    call frequent; it depends on its own letters alone, so an edit spoils those grams
    only that cover its place.
    """
    marked = _BEGIN + word + _END
    grams, covered = [], [0] * (len(marked) + 1)
    for at in range(len(marked) - 1):
        end = at + SHORTEST
        while end < len(marked) and end - at < LONGEST and marked[at:end] in often:
            end += 1
        grams.append(marked[at:end])
        covered[at] += 1
        covered[end] -= 1
    spoiled = running = 0
    for place, step in enumerate(covered):
        running += step
        if 0 < place < len(marked) - 1:
            spoiled = max(spoiled, running)
    return grams, spoiled


def _lists(words: DataFrame, often: set[str]) -> DataFrame:
    """The lists each word stands in: ``word, n, letters, gram, listed``.

    A near word shares all but ``spoiled`` of a word's grams, and the same holds the
    other way round; held in one order, the first ``spoiled + 1`` grams of both must meet.
    Rare grams come first. Equal grams of a word are told apart by their number.
    """
    shared = words.sparkSession.sparkContext.broadcast(often)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            tokens, needed = [], []
            for word in batch.column("word").to_pylist():
                grams, spoiled = decompose(word, known)
                met: Counter[str] = Counter()
                own = []
                for gram in grams:
                    met[gram] += 1
                    own.append(xxhash.xxh64_intdigest(gram, met[gram]) - (1 << 63))
                tokens.append(own)
                needed.append(spoiled + 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("word"), batch.column("n"), pa.array(tokens, pa.list_(pa.int64())), pa.array(needed, pa.int32())],
                ["word", "n", "grams", "needed"],
            )

    split = words.mapInArrow(run, "word string, n long, grams array<long>, needed int")
    rows = fixed(split.select("word", "n", "needed", F.explode("grams").alias("gram")))
    sizes = fixed(rows.groupBy("gram").agg(F.count("*").alias("listed")))
    ranked = (
        rows.join(sizes, "gram")
        .groupBy("word")
        .agg(
            F.first("n").alias("n"),
            F.first("needed").alias("needed"),
            F.sort_array(F.collect_list(F.struct("listed", "gram"))).alias("grams"),
        )
    )
    # One bit a letter, by its code point: an edit changes two bits at most.
    bits = F.aggregate(
        F.split("word", ""),
        F.lit(0).cast("long"),
        lambda mask, c: mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.ascii(c) % 64)),
    )
    return ranked.select(
        "word", "n", bits.alias("letters"), F.explode(F.slice("grams", F.lit(1), F.col("needed"))).alias("g")
    ).select("word", "n", "letters", F.col("g.gram").alias("gram"), F.col("g.listed").alias("listed"))


def near_words(words: DataFrame, dictionary: int = DICTIONARY) -> DataFrame:
    """Pairs of words one edit apart, each once: ``word, n, other, other_n`` with ``word < other``.

    ``words`` (``word, n``; words are distinct) of at least five code points. Only words that meet in a
    list are held against each other, letter sets first; what passes is verified. Lists with more than
    ``LIST_BLOCK`` words are cut, each word of one side going to every cut.
    """
    lists = fixed(_lists(words, gram_dictionary(words, dictionary)).filter("listed > 1"))
    left = lists.select("gram", "word", "n", "letters")
    right = lists.select("gram", F.col("word").alias("other"), F.col("n").alias("other_n"), F.col("letters").alias("other_letters"))
    near = (
        (F.col("word") < F.col("other"))
        & (F.bit_count(F.col("letters").bitwiseXOR(F.col("other_letters"))) <= 2)
        & (F.abs(F.length("word") - F.length("other")) <= 1)
        & (F.levenshtein("word", "other", 1) == 1)
    )
    in_cuts = F.col("listed") > LIST_BLOCK
    cuts = F.ceil(F.col("listed") / LIST_BLOCK).cast("int")
    short = left.join(lists.filter(in_cuts).select("gram").distinct(), "gram", "left_anti").join(
        right, "gram"
    ).filter(near)
    long_left = lists.filter(in_cuts).select(
        "gram", "word", "n", "letters", F.pmod(F.xxhash64("word"), cuts).cast("int").alias("cut")
    )
    long_right = lists.filter(in_cuts).select(
        "gram",
        F.col("word").alias("other"),
        F.col("n").alias("other_n"),
        F.col("letters").alias("other_letters"),
        F.explode(F.sequence(F.lit(0), cuts - 1)).alias("cut"),
    )
    long = long_left.join(long_right, ["gram", "cut"]).filter(near)
    columns = ["word", "n", "other", "other_n"]
    return short.select(*columns).unionByName(long.select(*columns)).distinct()


def variants(words: DataFrame, pairs: DataFrame, ratio: int = 2) -> DataFrame:
    """Every word with the form it is a variant of: ``word, form, root, n, n_near, form_n``.

    A word's form is its near word of largest ``n`` (ties: the smaller word) if that is at least ``ratio``
    times its own. Numbers grow from form to form, so chains end; each round puts the form's form in
    place of the form, which halves their length. A word without near words has none; no words give no rows.
    """
    both = pairs.unionByName(
        pairs.select(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    )
    best = both.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("minus"), "other")).alias("best")
    )
    joined = words.join(best, "word", "left")
    taken = -F.col("best.minus") >= ratio * F.col("n")
    every = fixed(
        joined.select(
            "word",
            F.when(taken, F.col("best.other")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(taken, -F.col("best.minus")).alias("form_n"),
        )
    )
    chains = fixed(every.filter("form IS NOT NULL").select("word", F.col("form").alias("root")))
    while True:
        further = chains.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        longer = fixed(chains.join(further, "root", "left").select("word", "root", "beyond"))
        if longer.filter("beyond IS NOT NULL").isEmpty():
            break
        chains = longer.select("word", F.coalesce("beyond", "root").alias("root"))
    return every.join(chains, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def spelling_variants(docs: DataFrame, min_chars: int = 5, min_count: int = 3, slips: int | None = None) -> DataFrame:
    """``variants`` of the words of ``docs``; other columns than ``doc_id`` and ``text`` play no part.

    Empty tables and texts without words give no rows, repeated rows count again,
    and a very long text is one list of words in its task.
    """
    if min_chars < LONGEST:
        raise ValueError(f"words need at least {LONGEST} code points")
    words = fixed(word_counts(docs, min_chars, min_count, slips))
    return variants(words, fixed(near_words(words)))
