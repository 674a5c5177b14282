"""Toxicity scores by weak supervision: voters, a generative label model, a linear classifier."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.llm.common import Words, as_bytes, listed_rows, mix, numbered, row_lists, settled, slices, tidy
from earshot.session import fixed

# Common English insults, a start where labels show little.
SEEDS = (
    "idiot moron stupid dumb loser scum trash garbage worthless pathetic disgusting clown fool jerk creep "
    "imbecile vermin filth freak coward"
).split()
# Lengths in bytes of the word beginnings that are features beside whole words.
BEGINNINGS = (4, 5, 6)
# Bounds of what is fitted: labelled rows that voters are mined from, rows the
# classifier is trained on, features of the classifier, voters.
SAMPLE_ROWS, VOCABULARY, VOTERS = 20_000, 512, 48
# A feature is in this share of the toxic rows at least, and of the rows that have it so many are toxic.
SUPPORT, PRECISION = 0.01, 0.9
ROUNDS = 6
FOLDS = 5


def held_out(doc_id: Column) -> Column:
    """Rows whose labels nothing is learned from."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS)) == 0


def features(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Text number and hash of every word and word beginning."""
    numbers, hashes = [words.text], [words.hashes(words.begin, words.length)]
    for size in BEGINNINGS:
        long = words.length > size
        begin = words.begin[long]
        numbers.append(words.text[long])
        hashes.append(mix(words.hashes(begin, np.full(len(begin), size)) + np.uint64(size)))
    return np.concatenate(numbers), np.concatenate(hashes)


def word_hash(word: str) -> int:
    words = Words([word.encode()], letters_only=True)
    return int(words.hashes(words.begin, words.length)[0])


class Vocabulary(NamedTuple):
    """Sorted feature hashes; which of them are voters (bit number, or -1), and which are seeds."""

    hashes: np.ndarray
    voter: np.ndarray
    seed: np.ndarray


#: Voters on patterns and on the seeds, as the bits above those of the features.
PATTERNS = ("any seed", "two seeds", "shouting", "exclamations", "masked word", "no feature")


def _pattern_bits(words: Words, count: int) -> np.ndarray:
    """Bits of the voters that look at characters, per text."""
    number = np.repeat(np.arange(count), np.diff(words.starts))
    raw = words.raw[: len(number)]
    tally = lambda mask: np.bincount(number[mask], minlength=count)
    upper, lower = tally((raw >= 65) & (raw <= 90)), tally((raw >= 97) & (raw <= 122))
    bits = (upper > 20) & (upper > lower)
    marks = tally(raw == 33) >= 3
    stars = np.zeros(len(raw), bool)
    stars[1:] = (raw[1:] == 42) & (raw[:-1] == 42)
    masked = tally(stars) > 0
    return bits.astype(np.int64) << 2 | marks.astype(np.int64) << 3 | masked.astype(np.int64) << 4


def describe(raw: list[bytes], vocabulary: Vocabulary) -> tuple[np.ndarray, list[bytes]]:
    """Votes as bits, and the vocabulary features as little-endian 16-bit numbers, of each text."""
    count, size = len(raw), len(vocabulary.hashes)
    words = Words(raw, letters_only=True)
    number, hashes = features(words)
    place = np.minimum(np.searchsorted(vocabulary.hashes, hashes), max(size - 1, 0))
    known = vocabulary.hashes[place] == hashes if size else np.zeros(len(hashes), bool)
    pairs = np.unique(number[known] * size + place[known])
    number, place = (pairs // size, pairs % size) if size else (pairs, pairs)
    votes = np.zeros(count, np.int64)
    voting = vocabulary.voter[place] >= 0
    np.bitwise_or.at(votes, number[voting], np.int64(1) << vocabulary.voter[place[voting]])
    seeds = np.bincount(number[vocabulary.seed[place]], minlength=count)
    own = np.bincount(number, minlength=count)
    patterns = (seeds > 0).astype(np.int64) | (seeds > 1).astype(np.int64) << 1 | _pattern_bits(words, count)
    votes |= (patterns | (own == 0).astype(np.int64) << 5) << VOTERS
    cuts = np.searchsorted(number, np.arange(count + 1))
    codes = place.astype("<u2")
    return votes, [codes[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]


def training_labels(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """``doc_id, toxic`` of at most ``rows`` labelled documents outside the held-out fold, by hash order."""
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    present = known.join(ids, "doc_id", "left_semi")
    return present.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def _counts(docs: DataFrame, wanted: np.ndarray | None) -> DataFrame:
    """Documents per feature; only wanted ones if given."""
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, raw in (part for batch in batches for part in slices(as_bytes(batch.column("text")))):
            words = Words(raw, letters_only=True)
            number, hashes = features(words)
            if shared.value is not None:
                size = len(shared.value)
                place = np.minimum(np.searchsorted(shared.value, hashes), size - 1)
                known = shared.value[place] == hashes
                number, hashes = number[known], hashes[known]
            order = np.lexsort((hashes, number))
            number, hashes = number[order], hashes[order]
            first = np.ones(len(hashes), bool)
            first[1:] = (np.diff(number) != 0) | (hashes[1:] != hashes[:-1])
            values, n = np.unique(hashes[first], return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(values.view(np.int64)), pa.array(n.astype(np.int64))], ["feature", "n"]
            )

    return docs.mapInArrow(run, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n"))


def _associated(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int) -> np.ndarray:
    """Likelihood-ratio statistic of features that go with toxic rows; 0 for the others."""
    total = n_toxic + n_clean

    def part(seen, expected):
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1e-9) / np.maximum(expected, 1e-9)), 0.0)

    present = toxic + clean
    g = part(toxic, present * n_toxic / total) + part(clean, present * n_clean / total)
    g += part(n_toxic - toxic, (total - present) * n_toxic / total)
    g += part(n_clean - clean, (total - present) * n_clean / total)
    return np.where(toxic * n_clean > clean * n_toxic, 2 * g, 0.0)


def mine_vocabulary(docs: DataFrame, sample: DataFrame) -> Vocabulary:
    """Features that stand out in toxic rows of the labelled sample, and the seeds.

    The bound on the statistic rises with the number of features tried, so that
    few pass it by chance. The sample's bound also bounds the counts that are collected.
    """
    # Copies of a text count once, so that its words do not look like a rule.
    own = numbered(docs).join(F.broadcast(sample), "doc_id").dropDuplicates(["text", "toxic"])
    sizes = dict(own.groupBy("toxic").count().collect())
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    kept, voter = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    seeds = np.array(sorted({word_hash(w) for w in SEEDS}), np.uint64)
    if n_toxic and n_clean:
        seen = _counts(own.filter("toxic = 1"), None).filter("n > 1").toArrow()
        hashes = seen["feature"].to_numpy().view(np.uint64)
        toxic = seen["n"].to_numpy()
        order = np.argsort(hashes)
        hashes, toxic = hashes[order], toxic[order]
        if len(hashes):
            clean = np.zeros(len(hashes), np.int64)
            there = _counts(own.filter("toxic = 0"), hashes).toArrow()
            clean[np.searchsorted(hashes, there["feature"].to_numpy().view(np.uint64))] = there["n"].to_numpy()
            score = _associated(toxic, clean, n_toxic, n_clean)
            score[(toxic < SUPPORT * n_toxic) | (toxic < PRECISION * (toxic + clean))] = 0
            best = np.lexsort((hashes, -score))[:VOCABULARY]
            best = best[score[best] > 2 * np.log(len(hashes) + 1)]
            kept, voter = hashes[best], np.arange(len(best))
    rank = dict(zip(kept.tolist(), voter.tolist()))
    hashes = np.unique(np.concatenate([kept, seeds]))
    number = np.array([rank.get(h, VOTERS) for h in hashes.tolist()], np.int64)
    return Vocabulary(hashes, np.where(number < VOTERS, number, -1), np.isin(hashes, seeds))


class LabelModel(NamedTuple):
    """Class weights, the voters' tree, and each voter's rate of firing by class and by what its parent does."""

    prior: float
    parent: np.ndarray
    rate: np.ndarray

    def posterior(self, fired: np.ndarray) -> np.ndarray:
        """Probability of the toxic class for rows of votes (0 or 1 per voter)."""
        above = np.where(self.parent < 0, 0, fired[:, self.parent])
        voters = np.arange(fired.shape[1])
        logs = []
        for label, weight in ((0, 1 - self.prior), (1, self.prior)):
            rate = self.rate[label, voters, above]
            logs.append(np.log(weight) + np.log(np.where(fired == 1, rate, 1 - rate)).sum(axis=1))
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -50, 50)))


def fit_tree(moments: np.ndarray, totals: np.ndarray) -> LabelModel:
    """Label model from expected co-firing counts by class.

    Correlated voters are tied by the tree of greatest mutual information given
    the class (Chow and Liu), so that two voters on one word count little more
    than one. Rates are smoothed by one row.
    """
    voters = moments.shape[1]
    fired = moments[:, np.arange(voters), np.arange(voters)]
    both = moments
    information = np.zeros((voters, voters))
    for label in (0, 1):
        n = totals[label] + 4e-3
        a = (fired[label][:, None] + 2e-3) / n
        b = (fired[label][None, :] + 2e-3) / n
        joint = (both[label] + 1e-3) / n
        cells = ((joint, a * b), (a - joint, a * (1 - b)), (b - joint, (1 - a) * b), (1 - a - b + joint, (1 - a) * (1 - b)))
        for seen, free in cells:
            seen = np.maximum(seen, 1e-12)
            information += totals[label] / totals.sum() * seen * np.log(seen / np.maximum(free, 1e-12))
    parent, reached = np.full(voters, -1), np.zeros(voters, bool)
    reached[0] = True
    for _ in range(voters - 1):
        gain = np.where(reached[:, None] & ~reached[None, :], information, -np.inf)
        above, below = np.unravel_index(np.argmax(gain), gain.shape)
        parent[below], reached[below] = above, True
    rate = np.empty((2, voters, 2))
    for label in (0, 1):
        mean = (fired[label] + 0.5) / (totals[label] + 1)
        for voter in range(voters):
            above = parent[voter]
            on = fired[label][above] if above >= 0 else 0.0
            pair = both[label][voter, above] if above >= 0 else 0.0
            off = totals[label] - on
            rate[label, voter, 1] = (pair + mean[voter]) / (on + 1)
            rate[label, voter, 0] = (fired[label][voter] - pair + mean[voter]) / (off + 1)
    prior = (totals[1] + 1) / (totals.sum() + 2)
    return LabelModel(float(prior), parent, np.clip(rate, 1e-6, 1 - 1e-6))


def _fired(votes: np.ndarray) -> np.ndarray:
    bits = np.arange(VOTERS + len(PATTERNS), dtype=np.int64)
    return (votes[:, None] >> bits & 1).astype(np.int64)


def _moments(patterns: DataFrame, model: LabelModel | None, known: float) -> tuple[np.ndarray, np.ndarray]:
    """Expected co-firing counts by class over all rows; known labels stand for themselves and weigh ``known``.

    Without a model, rows without a label hardly weigh anything and a seed decides.
    """
    voters = VOTERS + len(PATTERNS)
    cells = voters * voters + 1

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, cells))
        for batch in batches:
            fired = _fired(batch.column("votes").to_numpy())
            label = batch.column("label").to_numpy()
            weight = batch.column("n").to_numpy().astype(float)
            if model is not None:
                toxic = model.posterior(fired)
            else:
                toxic = np.where(fired[:, VOTERS] == 1, 0.9, 0.1)
                weight = np.where(label < 0, weight * 1e-3, weight)
            weight = np.where(label < 0, weight, weight * known)
            toxic = np.where(label < 0, toxic, label)
            for c, p in ((0, 1 - toxic), (1, toxic)):
                w = weight * p
                total[c, :-1] += ((fired * w[:, None]).T @ fired).ravel()
                total[c, -1] += w.sum()
        for c in (0, 1):
            used = np.flatnonzero(total[c])
            yield pa.RecordBatch.from_arrays(
                [pa.array(used + c * cells, pa.int64()), pa.array(total[c][used])], ["cell", "value"]
            )

    summed = patterns.mapInArrow(run, "cell long, value double").groupBy("cell").agg(F.sum("value").alias("value"))
    flat = np.zeros(2 * cells)
    rows = summed.toArrow()
    flat[rows["cell"].to_numpy()] = rows["value"].to_numpy()
    flat = flat.reshape(2, cells)
    return flat[:, :-1].reshape(2, voters, voters), flat[:, -1]


def fit_label_model(described: DataFrame, sample: DataFrame, rounds: int = ROUNDS) -> LabelModel:
    """Expectation maximisation over the vote patterns of all documents.

    Only labels of the sample are known; every other document takes part by its
    votes. Known labels together weigh as much as all other rows, so that the
    classes stay what the labels mean. What a round gathers has one number per
    pair of voters and class.
    """
    known = described.join(F.broadcast(sample), "doc_id", "left")
    patterns = fixed(
        known.groupBy("votes", F.coalesce("toxic", F.lit(-1)).cast("long").alias("label")).agg(F.count("*").alias("n"))
    )
    rows = patterns.agg(F.sum("n"), F.sum(F.when(F.col("label") >= 0, F.col("n")))).head()
    weight = max(1.0, ((rows[0] or 0) - (rows[1] or 0)) / max(rows[1] or 0, 1))
    model = None
    for _ in range(rounds):
        moments, totals = _moments(patterns, model, weight)
        if not totals.sum():
            moments, totals = moments + 1e-6, totals + 1e-3
        model = fit_tree(moments, totals)
    return model


def _matrix(codes: list[bytes], size: int) -> np.ndarray:
    out = np.zeros((len(codes), size + 1), np.float32)
    out[:, size] = 1
    for row, code in enumerate(codes):
        out[row, np.frombuffer(code, "<u2")] = 1
    return out


def fit_classifier(described: DataFrame, model: LabelModel, size: int, rows: int) -> np.ndarray:
    """Weights of a ridge logistic regression on posterior labels of at most ``rows`` documents by hash order.

    Known labels act through the label model alone.
    """
    free = described.filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    picked = free.orderBy(F.xxhash64("doc_id"), "_row").limit(rows).select("votes", "codes").toArrow()
    weights = np.zeros(size + 1)
    if not picked.num_rows:
        return weights
    x = _matrix(picked["codes"].to_pylist(), size).astype(np.float64)
    y = model.posterior(_fired(picked["votes"].to_numpy()))
    ridge = np.full(size + 1, 0.1)
    ridge[size] = 1e-6
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (p - y) + ridge * weights
        bend = (x * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(bend, slope)
        weights -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return weights


def score_documents(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Per row ``doc_id, held_out, score, predicted`` and the label model's ``posterior``.

    Voters are words and word beginnings that stand out in at most
    ``sample_rows`` labelled rows outside the held-out fold, a list of insults, and
    patterns of characters. All documents' votes go into the label model; its
    posteriors train a linear classifier on at most ``sample_rows`` documents; every
    whole text is scored. Null and empty texts get the score of a text without
    any feature; a very long text is described in slices; repeated rows are scored alike; without
    usable labels the list of insults alone decides; an empty table gives an empty result. Language,
    source and id are no inputs.
    """
    docs = settled(docs)
    sample = fixed(training_labels(docs, labels, sample_rows))
    vocabulary = mine_vocabulary(docs, sample)
    size = len(vocabulary.hashes)
    shared = docs.sparkSession.sparkContext.broadcast(tuple(vocabulary))

    @tidy
    def votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Vocabulary(*shared.value)
        for batch in batches:
            if batch.num_rows:
                parts = [describe(raw, own) for _, raw in slices(as_bytes(batch.column("text")))]
                bits = np.concatenate([b for b, _ in parts])
                codes = [c for _, own_codes in parts for c in own_codes]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("_row"), pa.array(bits), pa.array(codes, pa.binary())],
                    ["doc_id", "_row", "votes", "codes"],
                )

    described = fixed(numbered(docs).mapInArrow(votes, "doc_id long, _row long, votes long, codes binary"))
    model = fit_label_model(described, sample)
    weights = fit_classifier(described, model, size, sample_rows)

    @tidy
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                linear = _matrix(batch.column("codes").to_pylist(), size) @ weights
                posterior = model.posterior(_fired(batch.column("votes").to_numpy()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("_row"), pa.array(1 / (1 + np.exp(-linear)))]
                    + [pa.array(posterior)],
                    ["doc_id", "_row", "score", "posterior"],
                )

    scored = described.mapInArrow(score, "doc_id long, _row long, score double, posterior double")
    return scored.select(
        "doc_id",
        F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "posterior",
        "_row",
    )


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows that are not predicted toxic, with all their columns; null and empty texts stay."""
    docs = settled(docs)
    toxic = score_documents(docs, labels).filter("predicted = 1").select("_row")
    return listed_rows(docs, row_lists(toxic), keep=False)
