"""Similarity join of word-shingle sets and the components of its links."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.llm.blocks import BLOCKS, block_number, by_bucket, pack40, read_ipc, records, to_ipc, unpack40
from earshot.llm.common import ListedRows, Words, as_bytes, key_parts, listed_rows, mix, numbered, row_lists, settled, tidy
from earshot.llm.components import components
from earshot.session import fixed, scratch_path

WORDS, PERCENT = 5, 80
# Text hashed at a time.
SLICE_BYTES = 1 << 20
# Parts the tokens of a set are counted in for the suffix filter.
PARTS = 64
# Documents of a posting list that are held against its pivots before pairs are listed.
PIVOT_ROUNDS = 2
_SALT = np.uint64(0x9FB21C651E98DF25)


def least_overlap(n: int, percent: int = PERCENT) -> int:
    """Shingles a set of ``n`` shares with any set it links with, at least."""
    return -(-percent * n // 100)


def pair_overlap(n: int, m: int, percent: int = PERCENT) -> int:
    """Shingles sets of ``n`` and ``m`` share when they link, at least."""
    return -(-percent * (n + m) // (100 + percent))


def _extra(n: int) -> int:
    """Tokens two prefixes must share in the first filter (it grows with the set)."""
    return 1 + n // 8


def shingle_sets(raw: list[bytes], words_per: int = WORDS) -> Iterator[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text."""
    first, held = 0, 0
    for i in range(len(raw) + 1):
        if i < len(raw) and (held == 0 or held + len(raw[i]) <= SLICE_BYTES):
            held += len(raw[i]) + 1
            continue
        yield from _slice_sets(raw[first:i], words_per)
        if i < len(raw):
            first, held = i, len(raw[i]) + 1


def _slice_sets(raw: list[bytes], words_per: int) -> Iterator[np.ndarray]:
    words = Words(raw)
    hashes = words.hashes(words.begin, words.length)
    cuts = np.searchsorted(words.text, np.arange(len(raw) + 1))
    rolled = np.zeros(max(len(hashes) - words_per + 1, 0), np.uint64)
    for k in range(words_per):
        rolled = rolled * _SALT + hashes[k : k + len(rolled)]
    rolled = mix(rolled)
    for begin, end in zip(cuts.tolist(), cuts[1:].tolist()):
        if end - begin >= words_per:
            yield np.unique(rolled[begin : end - words_per + 1])
        elif end > begin:
            whole = np.array([end - begin], np.uint64)
            for k in range(begin, end):
                whole = whole * _SALT + hashes[k : k + 1]
            yield mix(whole)
        else:
            yield np.zeros(0, np.uint64)




def described(docs: DataFrame, words_per: int = WORDS, percent: int = PERCENT, buckets: int | None = None) -> DataFrame:
    """Per row ``doc_id, _row, n, sig, alive``: set size, digest of the set, and whether it can have a link.

    A set's prefix in hash order holds enough tokens that two linked sets share
    several of them. Blocks of documents send the prefix tokens to buckets, where
    a token of another block or document is recognised; what comes back is one
    number per document. A token that several documents of a block hold is sent
    once for all of them. Buckets see 40 bits of a token beside its bucket; a
    chance meeting only keeps a document that later steps drop.
    """
    buckets = buckets or key_parts(docs)

    @tidy
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, batch in enumerate(batches):
            if not batch.num_rows:
                continue
            block = block_number(number)
            sizes, digests, prefixes = [], [], []
            for tokens in shingle_sets(as_bytes(batch.column("text")), words_per):
                n = len(tokens)
                sizes.append(n)
                digests.append(hashlib.blake2b(tokens.tobytes(), digest_size=16).digest())
                prefixes.append(tokens[: n - least_overlap(n, percent) + _extra(n)] if n else tokens)
            owner = np.repeat(np.arange(len(sizes)), [len(p) for p in prefixes])
            keys = np.concatenate(prefixes)
            order = np.argsort(keys)
            keys, owner = keys[order], owner[order]
            first = np.ones(len(keys), bool)
            first[1:] = keys[1:] != keys[:-1]
            last = np.ones(len(keys), bool)
            last[:-1] = first[1:]
            single = first & last
            local = np.bincount(owner[~single], minlength=len(sizes)).astype("<u4")
            multiple = keys[first & ~single]
            keys, owner = keys[single], owner[single].astype("<u4")
            several = {b: multiple[at] for b, at in by_bucket(multiple, buckets)}
            rows = []
            for b, at in by_bucket(keys, buckets):
                more = several.pop(b, multiple[:0])
                shrink = lambda k: pack40(k // np.uint64(buckets))
                rows.append((b, block, False, shrink(keys[at]), owner[at].tobytes(), shrink(more)))
            for b, more in several.items():
                rows.append((b, block, False, b"", b"", pack40(more // np.uint64(buckets))))
            head = pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("_row"), pa.array(sizes, pa.int64())]
                + [pa.array(digests, pa.binary()), pa.array(local.astype(np.int64))],
                ["doc_id", "_row", "n", "sig", "shared"],
            )
            rows.append((block % buckets, block, True, to_ipc(head), b"", b""))
            yield records(rows)

    @tidy
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
                    owners = np.frombuffer(row[4], "<u4")[again[place] == own]
                    if len(owners):
                        found, n = np.unique(owners, return_counts=True)
                        yield records([(row[0], row[1], False, found.astype("<u4").tobytes(), n.astype("<u4").tobytes(), b"")])

    def merge(table: pa.Table) -> pa.Table:
        info = table["info"].to_pylist()
        head = read_ipc(table["keys"][info.index(True)].as_py())
        shared = head["shared"].to_numpy().copy()
        for flag, owners, counts in zip(info, table["keys"].to_pylist(), table["owners"].to_pylist()):
            if not flag:
                shared[np.frombuffer(owners, "<u4")] += np.frombuffer(counts, "<u4")
        n = head["n"].to_numpy()
        needed = np.array([_extra(least_overlap(int(x), percent)) for x in n])
        alive = (n > 0) & (shared >= needed)
        return head.drop_columns(["shared"]).append_column("alive", pa.array(alive))

    sent = numbered(docs).mapInArrow(send, BLOCKS)
    met = sent.repartition(buckets, "bucket").mapInArrow(meet, BLOCKS)
    return met.groupBy("block").applyInArrow(merge, "doc_id long, _row long, n long, sig binary, alive boolean")


_SETS = "block long, ids binary, sizes binary, tokens binary"


def _sets_of(docs: DataFrame, wanted: DataFrame, words_per: int) -> DataFrame:
    """Token sets of the wanted rows, a row per block of documents; the scan picks the rows itself."""
    path = row_lists(wanted)

    @tidy
    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed = ListedRows(path)
        for number, batch in enumerate(batches):
            if batch.num_rows:
                batch = batch.filter(pa.array(listed.among(batch.column("_row").to_numpy())))
            if batch.num_rows:
                sets = list(shingle_sets(as_bytes(batch.column("text")), words_per))
                arrays = [
                    pa.array([block_number(number)], pa.int64()),
                    pa.array([batch.column("_row").to_numpy().astype("<i8").tobytes()], pa.binary()),
                    pa.array([np.array([len(s) for s in sets], "<i8").tobytes()], pa.binary()),
                    pa.array([np.concatenate(sets).astype("<u8").tobytes()], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(arrays, ["block", "ids", "sizes", "tokens"])

    return numbered(docs).mapInArrow(collect, _SETS)


def _prefix_entries(sets: DataFrame, percent: int, buckets: int) -> DataFrame:
    """``token, id, n, pos`` of the prefix tokens that more than one set holds, rarest tokens first.

    Tokens are counted over all sets, in buckets, and the counts return to the
    blocks they came from. A set's tokens are ordered by count and hash; tokens of
    one set only come first and are left out of the result, since they meet
    nobody. ``pos`` is the token's place in that order.
    """

    @tidy
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, data in zip(batch.column("block").to_pylist(), batch.column("tokens").to_pylist()):
                keys, counts = np.unique(np.frombuffer(data, "<u8"), return_counts=True)
                rows = []
                for b, at in by_bucket(keys, buckets):
                    rows.append((b, block, False, keys[at].tobytes(), counts[at].astype("<u4").tobytes(), b""))
                if rows:
                    yield records(rows)

    @tidy
    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple]] = {}
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                held.setdefault(row[0], []).append(row)
        for rows in held.values():
            keys = [np.frombuffer(r[3], "<u8") for r in rows]
            every, back = np.unique(np.concatenate(keys), return_inverse=True)
            sums = np.bincount(back, np.concatenate([np.frombuffer(r[4], "<u4") for r in rows]), len(every))
            for row, own in zip(rows, keys):
                n = sums[np.searchsorted(every, own)].astype("<u4")
                several = n > 1
                if several.any():
                    yield records([(row[0], row[1], False, own[several].tobytes(), n[several].tobytes(), b"")])

    def order(left: pa.Table, right: pa.Table) -> pa.Table:
        out = ([], [], [], [])
        if left.num_rows and right.num_rows:
            keys = np.concatenate([np.frombuffer(x, "<u8") for x in right["keys"].to_pylist()])
            counts = np.concatenate([np.frombuffer(x, "<u4") for x in right["owners"].to_pylist()])
            sorting = np.argsort(keys)
            keys, counts = keys[sorting], counts[sorting]
            ids = np.frombuffer(left["ids"][0].as_py(), "<i8")
            sizes = np.frombuffer(left["sizes"][0].as_py(), "<i8")
            tokens = np.frombuffer(left["tokens"][0].as_py(), "<u8")
            ends = np.cumsum(sizes)
            for i, (number, n, end) in enumerate(zip(ids.tolist(), sizes.tolist(), ends.tolist())):
                own = tokens[end - n : end]
                place = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
                common = keys[place] == own
                alone = n - int(common.sum())
                wanted = n - least_overlap(n, percent) + 1 - alone
                if wanted <= 0:
                    continue
                own, many = own[common], counts[place[common]]
                rare = np.lexsort((own, many))[:wanted]
                out[0].append(own[rare])
                out[1].append(np.full(len(rare), number))
                out[2].append(np.full(len(rare), n))
                out[3].append(alone + np.arange(len(rare)))
        column = lambda parts, kind: np.concatenate(parts).astype(kind) if parts else np.zeros(0, kind)
        arrays = [pa.array(column(out[0], np.uint64).view(np.int64))] + [pa.array(column(c, np.int64)) for c in out[1:]]
        return pa.table(arrays, ["token", "id", "n", "pos"])

    counted = sets.select("block", "tokens").mapInArrow(send, BLOCKS).repartition(buckets, "bucket")
    counts = counted.mapInArrow(total, BLOCKS).select("block", "keys", "owners")
    return (
        sets.groupBy("block")
        .cogroup(counts.groupBy("block"))
        .applyInArrow(order, "token long, id long, n long, pos long")
    )


def _rows_of(sets: DataFrame) -> DataFrame:
    """One row per set: ``id, n, tokens`` and the counts of its tokens by part."""

    @tidy
    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, sizes, data in zip(*[batch.column(c).to_pylist() for c in ("ids", "sizes", "tokens")]):
                ids, sizes, tokens = np.frombuffer(ids, "<i8"), np.frombuffer(sizes, "<i8"), np.frombuffer(data, "<u8")
                ends = np.cumsum(sizes)
                own = [tokens[e - n : e] for e, n in zip(ends.tolist(), sizes.tolist())]
                parts = [np.bincount((t % np.uint64(PARTS)).astype(np.int64), minlength=PARTS) for t in own]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids), pa.array(sizes), pa.array([t.tobytes() for t in own], pa.binary())]
                    + [pa.array([p.astype("<u4").tobytes() for p in parts], pa.binary())],
                    ["id", "n", "tokens", "parts"],
                )

    return sets.mapInArrow(spread, "id long, n long, tokens binary, parts binary")


@contextmanager
def _stored_rows(sets: DataFrame, buckets: int) -> Iterator[DataFrame]:
    """The sets by id as a table in buckets: joins with pairs move the pairs only."""
    spark = sets.sparkSession
    name = f"earshot_sets_{uuid.uuid4().hex}"
    spread = _rows_of(sets).repartition(buckets, "id")
    spread.write.bucketBy(buckets, "id").option("path", scratch_path(spark, "sets")).saveAsTable(name)
    try:
        yield spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")


def _possible(n: str, m: str, i: str, j: str, percent: int) -> str:
    """Length and positional filter as a condition: sizes that can link, and enough tokens from the places on."""
    return (
        f"100 * least({n}, {m}) >= {percent} * greatest({n}, {m}) AND "
        f"{100 + percent} * least({n} - {i}, {m} - {j}) >= {percent} * ({n} + {m})"
    )


def _suffix_filter(pairs: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """Pairs whose tokens, counted part by part, could overlap enough."""
    side = lambda name: rows.select(F.col("id").alias(name), F.col("n").alias(f"n_{name}"), F.col("parts").alias(f"p_{name}"))
    joined = pairs.join(side("a"), "a").join(side("b"), "b")

    @tidy
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                parts = [
                    np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u4").reshape(-1, PARTS) for c in ("p_a", "p_b")
                ]
                most = np.minimum(*parts).sum(axis=1).astype(np.int64)
                sizes = batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()
                enough = (100 + percent) * most >= percent * sizes
                yield batch.select(["a", "b"]).filter(pa.array(enough))

    return joined.mapInArrow(keep, "a long, b long")


def _verified(pairs: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """Pairs that link, by their whole sets."""
    side = lambda name: rows.select(F.col("id").alias(name), F.col("tokens").alias(f"t_{name}"))
    joined = _suffix_filter(pairs, rows, percent).join(side("a"), "a").join(side("b"), "b")

    @tidy
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                linked = []
                for x, y in zip(batch.column("t_a"), batch.column("t_b")):
                    x, y = np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8")
                    both = np.sort(np.concatenate([x, y]), kind="stable")
                    common = int((both[1:] == both[:-1]).sum())
                    linked.append(100 * common >= percent * (len(x) + len(y) - common))
                yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    return joined.mapInArrow(keep, "a long, b long")


def similar_sets(sets: DataFrame, percent: int = PERCENT, buckets: int = 8) -> DataFrame:
    """``id, label`` of the sets that have links; the label is the least id reachable.

    Sets that share a prefix token are held against the list's pivots first
    (the one whose token stands earliest, so that has fewest rare tokens of its
    own): a list of near copies becomes one component by as many comparisons as
    it has members. Pairs still in different components are then all listed,
    each once, through the length, positional and suffix filters, and verified.
    Links inside a component that is known already are not looked for: they
    change nothing.
    """
    with _stored_rows(sets, buckets) as rows:
        return components(_links(fixed(_prefix_entries(sets, percent, buckets)), rows, percent))


def _links(entries: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """Enough links to connect whatever links connect, written down."""
    labels = links = tested = None

    def verified(pairs: DataFrame) -> None:
        """Look at the pairs that were not looked at before."""
        nonlocal links, tested
        new = pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti")
        new = fixed(new)
        found = fixed(_verified(new, rows, percent))
        tested = new if tested is None else tested.unionByName(new)
        links = found if links is None else links.unionByName(found)

    for turn in range(PIVOT_ROUNDS):
        own = _labelled(entries, labels)
        first = F.min(F.struct("pos", "id", "n", "label")) if turn == 0 else F.max(F.struct("pos", "id", "n", "label"))
        pivots = own.groupBy("token").agg(first.alias("p"), F.min("label").alias("low"), F.max("label").alias("high"))
        pivots = pivots.filter("low <> high").select(
            "token", F.col("p.id").alias("p_id"), F.col("p.n").alias("p_n"), F.col("p.pos").alias("p_pos"), F.col("p.label").alias("p_label")
        )
        met = own.join(pivots, "token").filter("label <> p_label")
        met = met.filter(_possible("n", "p_n", "pos", "p_pos", percent))
        verified(met.select(F.least("id", "p_id").alias("a"), F.greatest("id", "p_id").alias("b")).distinct())
        labels = fixed(components(links))
    own = _labelled(entries, labels)
    mixed = own.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low <> high")
    rest = fixed(own.join(mixed.select("token"), "token"))
    other = rest.select("token", *[F.col(c).alias(f"o_{c}") for c in ("id", "n", "pos", "label")])
    verified(
        rest.join(other, "token")
        .filter("id < o_id AND label <> o_label")
        .filter(_possible("n", "o_n", "pos", "o_pos", percent))
        .select(F.col("id").alias("a"), F.col("o_id").alias("b"))
        .distinct()
    )
    return links


def _labelled(entries: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return entries.withColumn("label", F.col("id"))
    known = entries.join(labels, "id", "left")
    return known.withColumn("label", F.coalesce("label", "id"))


def similarity_classes(docs: DataFrame, words_per: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Per row ``doc_id, n_shingles, component_id`` and ``_row``.

    A row's set is its distinct ``words_per``-word shingles (A-Z in lower case, words
    are runs without ASCII white space); a text of fewer words is one shingle.
    Rows link when the Jaccard similarity of their sets is at least
    ``percent`` / 100; ``component_id`` is the smallest doc_id that links reach. Null,
    empty and blank texts have no shingles and no links. Equal sets are one
    class and searched once; repeated rows are equal sets. Rows whose doc_id is null
    take part, and are named by null unless linked with others. A very long text is one large set. Other
    columns play no part; an empty table gives an empty result.
    """
    docs = settled(docs)
    buckets = key_parts(docs)
    base = fixed(described(docs, words_per, percent, buckets))
    filled = base.filter("n > 0")
    classes = fixed(
        filled.groupBy("sig").agg(
            F.min("_row").alias("rep"), F.min("doc_id").alias("least"), F.max("alive").alias("alive")
        )
    )
    wanted = classes.filter("alive").select(F.col("rep").alias("_row"))
    sets = fixed(_sets_of(docs, wanted, words_per))
    labels = fixed(similar_sets(sets, percent, buckets))
    known = classes.join(labels.withColumnRenamed("id", "rep"), "rep")
    least = known.groupBy("label").agg(F.min("least").alias("component_id"))
    named = known.join(least, "label").select("sig", F.col("component_id").alias("wider"))
    # Written down, so that the rows of a class that most rows are in can be split in the join below.
    every = fixed(classes.join(named, "sig", "left").select("sig", F.coalesce("wider", "least").alias("component_id")))
    shown = ["doc_id", F.col("n").alias("n_shingles"), "component_id", "_row"]
    with_class = filled.join(every, "sig").select(*shown)
    empty = base.filter("n = 0").withColumn("component_id", F.col("doc_id")).select(*shown)
    return with_class.unionByName(empty)


def one_per_class(docs: DataFrame) -> DataFrame:
    """The row with the smallest doc_id of each class (of rows that share it, the first), with all columns."""
    docs = settled(docs)
    classes = similarity_classes(docs)
    alone = F.when(F.col("n_shingles") == 0, F.col("_row"))
    same = classes.groupBy("component_id", alone.alias("alone")).agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row")).alias("first")
    )
    return listed_rows(docs, row_lists(same.select("first._row")))
