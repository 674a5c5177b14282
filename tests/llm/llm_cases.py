"""Rows and brute-force versions the tests of this folder share."""

import re

from pyspark.sql import types as T

SPACES = re.compile(r"[\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

# Column names the operators use themselves, as extra columns of the input.
SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        T.StructField("_row", T.StringType()),
        T.StructField("shard", T.StringType()),
        T.StructField("digest", T.StringType()),
        T.StructField("start", T.StringType()),
        T.StructField("label", T.StringType()),
        T.StructField("kept", T.StringType()),
        T.StructField("odd.name", T.StringType()),
    ]
)


def words(n, seed=1):
    return " ".join(f"w{(i * 7919 + seed * 104729) % 100003}x" for i in range(n))


LINE = "a line that many of the documents have in common"


def odd_rows():
    """Nulls, empty and blank texts, long ones, ties, repeated rows, near copies."""
    base = words(120, 3)
    near = base.replace("w", "v", 2)
    rows = [
        (5, None),
        (6, ""),
        (7, " \t\n"),
        (8, "short"),
        (9, "Short"),
        (10, "one two  three"),
        (11, "one two\tthree"),
        (12, base),
        (13, base),
        (14, near),
        (15, base.upper()),
        (16, words(6000, 9) + "\n" + LINE + "\n" + words(3000, 11)),
        (17, words(30, 5) + "\n" + LINE + "\n" + words(30, 6)),
        (17, words(30, 5) + "\n" + LINE + "\n" + words(30, 6)),
        (18, "é" * 130 + " ü " + "é" * 130),
        (None, base),
        (None, None),
        (19, LINE + "\n" + LINE),
        (20, "x" * 5000),
        (3, words(40, 21) + " " + words(200, 3)),
    ]
    extra = ("en", None, 1, "r", "s", "d", "t", "l", "k", "o")
    return [(*r, *extra) for r in rows]


def frame(spark, rows=None):
    return spark.createDataFrame(odd_rows() if rows is None else rows, SCHEMA).repartition(3, "n_chars", "doc_id").sortWithinPartitions("doc_id")


def stored(spark, folder, rows=None):
    """The rows as a Parquet table, as a pipeline stage gets them."""
    path = f"{folder}/docs"
    frame(spark, rows).write.parquet(path)
    return spark.read.parquet(path)


def plain_docs(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")


def normal(text):
    return SPACES.sub(" ", text or "")


def shingles(text):
    own = [w for w in SPACES.split((text or "").translate(LOWER)) if w]
    return frozenset(tuple(own[i : i + 5]) for i in range(max(1, len(own) - 4))) if own else frozenset()


def classes(rows):
    """Set size and smallest reachable id per row, by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(doc_id, least.get(find(i), doc_id))
    return [(doc_id, len(sets[i]), least.get(find(i))) for i, (doc_id, _) in enumerate(rows)]


def repeats(rows, length=100):
    """Bytes, removed bytes, removed runs and what is left per row, string by string."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
    seen, out = set(), {}
    for i in order:
        data = (rows[i][1] or "").encode()
        gone = [False] * len(data)
        for at in range(len(data) - length + 1):
            string = data[at : at + length]
            if string in seen:
                gone[at : at + length] = [True] * length
            else:
                seen.add(string)
        runs = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out[i] = (rows[i][0], len(data), sum(gone), runs, bytes(b for b, g in zip(data, gone) if not g))
    return [out[i] for i in range(len(rows))]
