"""Line deduplication over levelled sorted runs of line hashes (DataFrame operations only)."""

from __future__ import annotations

import math
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.functions.once import let
from earshot.llm.common import texts
from earshot.session import fixed, scratch_path

# Batches one call cuts its documents into, and runs of a level that are merged into one of the next.
BATCHES, FANOUT = 4, 2
# Lines per bucket of a run; a bucket is merged as a stream, sorted with spilling.
BUCKET_LINES = 16_000_000
# A digest with more than one line in HOT of all lines is settled where it is read: HOT digests at most.
HOT = 1_000
STRIPPED = " \t\n\x0b\f\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(STRIPPED)), _UPPER, _LOWER)


class LineRuns:
    """Digests of all lines met so far, as sorted runs in levels.

    A run is a table bucketed and sorted by digest, so batches and runs meet bucket
    by bucket in merge joins that move only the batch. A digest stands in one run: that of
    the first batch that held it. What a later batch adds to it stands in that
    batch's own table as ``known`` rows. ``fanout`` runs of a level become one of the next,
    so a batch is held against a number of runs that grows with the logarithm of the
    number of batches.
    """

    def __init__(self, spark: SparkSession, buckets: int, fanout: int = FANOUT):
        self.spark, self.buckets, self.fanout = spark, buckets, fanout
        self.levels: list[list[str]] = []
        self.added: list[str] = []
        self._made: list[str] = []

    def _write(self, rows: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        self._made.append(name)
        writer = rows.write.format("parquet").bucketBy(self.buckets, "digest").sortBy("digest")
        writer.option("path", scratch_path(self.spark, name)).saveAsTable(name)
        return name

    def _run(self, name: str) -> DataFrame:
        return self.spark.table(name).filter("NOT known")

    def runs(self) -> list[str]:
        return [name for level in self.levels for name in level]

    def add(self, lines: DataFrame) -> None:
        """Lines ``digest, doc_id`` of documents that no earlier batch held."""
        own = lines.groupBy("digest").agg(
            F.count_distinct("doc_id").alias("n_docs"), F.max("doc_id").alias("last_doc")
        )
        found = [F.lit(False)]
        for i, name in enumerate(self.runs()):
            run = self._run(name).select("digest", F.lit(True).alias(f"in_{i}")).hint("merge")
            own = own.join(run, "digest", "left")
            found.insert(0, F.col(f"in_{i}"))
        if len(found) == 1:
            own = own.repartition(self.buckets, "digest")
        name = self._write(own.select("digest", "n_docs", "last_doc", F.coalesce(*found).alias("known")))
        self.added.append(name)
        self._place(0, name)

    def _place(self, level: int, name: str) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) == self.fanout:
            # The runs share no digest; grouping keeps their buckets together, so nothing is moved.
            merged = (
                reduce(DataFrame.unionByName, [self._run(n) for n in self.levels[level]])
                .groupBy("digest")
                .agg(F.sum("n_docs").alias("n_docs"), F.max("last_doc").alias("last_doc"))
                .withColumn("known", F.lit(False))
            )
            self.levels[level] = []
            self._place(level + 1, self._write(merged))

    def frequent(self, min_docs: int) -> DataFrame:
        """``digest, n_docs, last_doc`` of the digests that at least ``min_docs`` documents hold, written down."""
        known = [self.spark.table(name).filter("known") for name in self.added]
        later = (
            reduce(DataFrame.unionByName, known)
            .groupBy("digest")
            .agg(F.sum("n_docs").alias("later_docs"), F.max("last_doc").alias("later_doc"))
            .hint("merge")
        )
        n_docs = F.col("n_docs") + F.coalesce("later_docs", F.lit(0))
        totals = [
            self._run(name)
            .join(later, "digest", "left")
            .select("digest", n_docs.alias("n_docs"), F.greatest("last_doc", "later_doc").alias("last_doc"))
            .filter(F.col("n_docs") >= min_docs)
            for name in self.runs()
        ]
        return fixed(reduce(DataFrame.unionByName, totals))

    def close(self) -> None:
        """Take the runs' names out of the catalogue."""
        for name in self._made:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def _lines(docs: DataFrame, min_chars: int, batches: int) -> DataFrame:
    """One row per line that is long enough, in folders by batch: ``digest, doc_id, text_key, pos, batch``."""
    keyed = F.transform(
        F.split("text", "\n", -1), lambda line, i: F.struct(_key(line).alias("key"), i.cast("int").alias("pos"))
    )
    rows = docs.filter("doc_id IS NOT NULL").select(
        "doc_id",
        F.xxhash64("text").alias("text_key"),
        F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int").alias("batch"),
        F.explode(F.filter(keyed, lambda line: F.length(line["key"]) >= min_chars)).alias("line"),
    )
    rows = rows.select(
        F.unhex(F.md5("line.key")).alias("digest"), "doc_id", "text_key", F.col("line.pos").alias("pos"), "batch"
    )
    path = scratch_path(docs.sparkSession, "lines")
    rows.write.partitionBy("batch").parquet(path)
    return docs.sparkSession.read.schema(rows.schema).parquet(path)


def _lost(lines: DataFrame, frequent: DataFrame, n_lines: int) -> DataFrame:
    """Lines of frequent digests outside the document that keeps them.

    The documents of all digests add up to no more than ``n_lines``, so at most
    ``HOT`` digests have more than their share and are broadcast; the others are shuffled.
    """
    kept = frequent.select("digest", F.col("last_doc").alias("keep_doc"), (F.col("n_docs") * HOT > n_lines).alias("hot"))
    hot = F.broadcast(kept.filter("hot").drop("hot"))
    common = lines.join(hot, "digest")
    rest = lines.join(hot.select("digest"), "digest", "left_anti").join(kept.filter("NOT hot").drop("hot"), "digest")
    return common.unionByName(rest).filter("doc_id <> keep_doc")


def drop_repeated_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, batches: int = BATCHES) -> DataFrame:
    """Every row as ``doc_id, text`` (what is left), ``n_lines`` (before) and ``n_dropped``.

    A line's key is the line without ASCII white space at both ends, A-Z in lower case.
    Keys of ``min_chars`` code points and more that ``min_docs`` documents hold lose
    their lines everywhere but in the greatest ``doc_id`` that holds them. Documents are dealt
    over ``batches`` by hash of their id; each batch is held against the runs of the
    ones before and adds its own. Rows that share an id are one document. Rows without an id
    keep all lines and count for none. A null or empty text is one empty line; a text of any
    length is one row, its lost lines one list of places. Ties cannot be: ids differ. Other columns play no
    part, whatever their names; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    plain = texts(docs)
    lines = _lines(plain, min_chars, batches)
    n_lines = lines.count()
    at_least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    runs = LineRuns(spark, max(at_least, math.ceil(n_lines / BUCKET_LINES)))
    for batch in range(batches):
        runs.add(lines.filter(F.col("batch") == batch).select("digest", "doc_id"))
    frequent = runs.frequent(min_docs)
    runs.close()
    # Written down, so that rows which share id and text can be split in the join below.
    lost = fixed(
        _lost(lines, frequent, n_lines).groupBy("doc_id", "text_key").agg(F.collect_set("pos").alias("lost"))
    )
    rows = plain.withColumn("text_key", F.xxhash64("text")).join(lost, ["doc_id", "text_key"], "left")
    n_dropped = F.coalesce(F.size("lost"), F.lit(0)).cast("long")
    kept = let(
        F.split("text", "\n", -1),
        lambda parts: F.array_join(
            F.transform(
                F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("lost")), lambda i: F.get(parts, i)
            ),
            "\n",
        ),
    )
    return rows.select(
        "doc_id",
        F.when(F.col("lost").isNull(), F.col("text")).otherwise(kept).alias("text"),
        F.size(F.split("text", "\n", -1)).cast("long").alias("n_lines"),
        F.when(F.col("lost").isNull(), F.lit(0)).otherwise(n_dropped).cast("long").alias("n_dropped"),
    )
