"""Exact deduplication with frequent digests split off (DataFrame operations only)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from earshot.llm.common import SPACE, quoted, settled
from earshot.session import fixed

# Size of the summary of frequent items, and how many of them are split off.
TRACKED = 10_000
HEAVY = 1_000


def _digest(text):
    normalised = F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")
    return F.unhex(F.sha2(normalised, 256))


def frequent(rows: DataFrame, heavy: int = HEAVY, tracked: int = TRACKED) -> DataFrame:
    """Fingerprints that the Misra-Gries summary of all rows holds as frequent; ``heavy`` rows at most.

    ``approx_top_k`` is Spark's mergeable summary of the Misra-Gries family:
    any digest with more than ``3.5 / tracked`` of the rows is in it.
    """
    top = rows.agg(F.expr(f"approx_top_k(_print, {heavy}, {tracked})").alias("top"))
    return top.select(F.explode("top").alias("t")).filter("t.count > 1").select(F.col("t.item").alias("_print"))


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", heavy: int = HEAVY, tracked: int = TRACKED
) -> DataFrame:
    """Every row with the row of equal text that stays: ``grouped_rows`` without the row number."""
    return grouped_rows(docs, id_col, text_col, heavy, tracked).drop("_row")


def grouped_rows(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", heavy: int = HEAVY, tracked: int = TRACKED
) -> DataFrame:
    """Every row with the row of equal text that stays.

    Texts are equal when their normalised forms are (runs of ASCII white space
    count as one space; null counts as empty). Of a group the row with the
    smallest id stays; a null id comes last, and of rows that share the id one
    stays. Frequent digests are found by a Misra-Gries summary, their winners
    are counted exactly and, being ``heavy`` at most, broadcast: their copies are
    settled where they are read. All other digests meet in one shuffle of slim
    rows. Columns: ``doc_id, keep_id, group_size, kept, text_sha256, _row``; other
    columns of the input, whatever their names, play no part. A text of any length is
    digested whole. An empty table gives an empty result.
    """
    slim = fixed(
        docs.select(
            quoted(id_col).alias("doc_id"),
            _digest(quoted(text_col)).alias("_digest"),
            F.monotonically_increasing_id().alias("_row"),
        ).withColumn("_print", F.xxhash64("_digest"))
    )
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row")
    winners = fixed(
        slim.join(F.broadcast(frequent(slim, heavy, tracked)), "_print")
        .groupBy("_digest")
        .agg(F.min(rank).alias("_keep"), F.count("*").alias("group_size"))
    )
    common = slim.join(F.broadcast(winners), "_digest")
    same = Window.partitionBy("_digest")
    rest = (
        slim.join(F.broadcast(winners.select("_digest")), "_digest", "left_anti")
        .withColumn("_keep", F.min(rank).over(same))
        .withColumn("group_size", F.count("*").over(same))
    )
    columns = [
        F.col("doc_id"),
        F.col("_keep.doc_id").alias("keep_id"),
        F.col("group_size"),
        (F.col("_keep._row") == F.col("_row")).alias("kept"),
        F.lower(F.hex("_digest")).alias("text_sha256"),
        F.col("_row"),
    ]
    return common.select(*columns).unionByName(rest.select(*columns))


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows that stay, with all their columns; texts are moved once. Nulls, ties and empty tables as above."""
    docs = settled(docs)
    dropped = grouped_rows(docs).filter("NOT kept").select(F.col("_row").alias("_exact_row"))
    rows = docs.withColumn("_exact_row", F.monotonically_increasing_id())
    return rows.join(dropped, "_exact_row", "left_anti").select(*[quoted(c) for c in docs.columns])
