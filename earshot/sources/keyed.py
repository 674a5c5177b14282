"""Stored datasets in key buckets: a lookup opens the buckets asked for, a replacement rewrites those it touches.

A dataset is Parquet below ``buckets=<how many>/bucket=<which one>``. The
number of buckets stands in the folder name, so it is stored with the data and
every reader and writer finds it there; the largest one with a success marker counts.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from earshot.session import fixed
from earshot.sources.tables import file_system, path_exists

# Bytes of values a bucket should hold, and how far it may outgrow that before the dataset is dealt anew.
BUCKET_BYTES, GROWTH = 64 << 20, 4
# An empty file beside the buckets with the columns of all of them; scans pass names like this over.
SCHEMA = "_columns"


@dataclass(frozen=True)
class Written:
    """What a write did: the folder, how many buckets it has, which were written, and the columns."""

    folder: str
    buckets: int
    written: list[int]
    columns: T.StructType


def bucket_of(keys: list[str], buckets: Column) -> Column:
    """Bucket of a key. Keys count as text, so numbers and folder names meet."""
    return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), buckets).cast("int")


def bucket_count(spark: SparkSession, path: str) -> int | None:
    """Number of buckets of a stored dataset; nothing where none was written completely."""
    if not path_exists(spark, path):
        return None
    fs, folder = file_system(spark, path)
    names = [status.getPath().getName() for status in fs.listStatus(folder)]
    counts = [int(n.split("=")[1]) for n in names if n.startswith("buckets=")]
    return max((n for n in counts if path_exists(spark, f"{path}/buckets={n}/_SUCCESS")), default=None)


def _needed(bytes_: int) -> int:
    """Buckets for so many bytes: a power of two, so that a bucket is split when the number grows."""
    return 1 << max(0, math.ceil(math.log2(max(1, bytes_ / BUCKET_BYTES))))


def _deal(df: DataFrame, path: str, keys: list[str], order: str | None, buckets: int, mode: str) -> None:
    sorting = ["bucket", *keys, *([order] if order else [])]
    dealt = df.withColumn("bucket", bucket_of(keys, F.lit(buckets)))
    # Ranges split evenly whatever the buckets, also where one key has very many rows.
    spread = dealt.repartitionByRange(*sorting) if buckets > 1 else dealt
    (
        spread.sortWithinPartitions(*sorting)
        .write.partitionBy("bucket")
        .option("partitionOverwriteMode", mode)
        .mode("overwrite")
        .parquet(f"{path}/buckets={buckets}")
    )
    # All columns any file has, so that readers need not open every file to find them.
    df.limit(0).write.mode("overwrite").parquet(f"{path}/buckets={buckets}/{SCHEMA}")


def _weight(df: DataFrame) -> Column:
    """Bytes of a row, near enough."""
    sizes = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            sizes.append(F.octet_length(column))
        elif isinstance(field.dataType, T.ArrayType):
            sizes.append(F.size(column) * 8)
        else:
            sizes.append(F.lit(8))
    return reduce(Column.__add__, [F.coalesce(size, F.lit(0)).cast("long") for size in sizes])


def store(df: DataFrame, path: str, keys: list[str], order: str | None = None, buckets: int | None = None) -> Written:
    """Write a whole dataset; what stood there before is gone once the new one is complete."""
    spark = df.sparkSession
    if buckets is None:
        buckets = _needed(df.agg(F.coalesce(F.sum(_weight(df)), F.lit(0))).head()[0])
    _deal(df, path, keys, order, buckets, "static")
    fs, folder = file_system(spark, path)
    for status in fs.listStatus(folder):
        name = status.getPath().getName()
        if name.startswith("buckets=") and name != f"buckets={buckets}":
            fs.delete(status.getPath(), True)
    return Written(f"{path}/buckets={buckets}", buckets, list(range(buckets)), df.schema)


def replace(df: DataFrame, path: str, keys: list[str], order: str | None = None) -> Written:
    """Put the rows of ``df`` in place of all stored rows of the same keys.

    Only the buckets of these keys are read and written again, each in one
    step, so a run repeated after a failure ends with the same rows. New columns may appear; rows
    without them have nulls. A dataset that outgrew its buckets is dealt over more.
    """
    spark = df.sparkSession
    buckets = bucket_count(spark, path)
    if buckets is None:
        return store(df, path, keys, order)
    new = fixed(df)
    touched = _asked(new, keys, buckets)
    folder = f"{path}/buckets={buckets}"
    # Numbers of buckets, no more than there are.
    stored = _read(spark, folder).filter(F.col("bucket").isin(touched)).drop("bucket")
    kept = stored.join(new.select(*keys).distinct(), keys, "left_anti")
    both = kept.unionByName(new, allowMissingColumns=True)
    _deal(both, path, keys, order, buckets, "dynamic")
    fs, place = file_system(spark, folder)
    held = fs.getContentSummary(place).getLength()
    if held > GROWTH * BUCKET_BYTES * buckets:
        whole = _read(spark, folder).drop("bucket")
        return store(whole, path, keys, order, _needed(held))
    return Written(folder, buckets, touched, both.schema)


def _asked(rows: DataFrame, keys: list[str], buckets: int) -> list[int]:
    """Buckets the keys of some rows fall into; numbers, no more than there are buckets."""
    return sorted(r[0] for r in rows.select(bucket_of(keys, F.lit(buckets)).alias("b")).distinct().collect())


def _read(spark: SparkSession, folder: str) -> DataFrame:
    """A folder with its buckets; rows written before a column came have nulls in it."""
    if not path_exists(spark, f"{folder}/{SCHEMA}"):
        return spark.read.parquet(folder)
    columns = spark.read.parquet(f"{folder}/{SCHEMA}").schema
    return spark.read.schema(T.StructType([*columns.fields, T.StructField("bucket", T.IntegerType())])).parquet(folder)


def read(spark: SparkSession, path: str) -> DataFrame:
    """All rows of a stored dataset."""
    buckets = bucket_count(spark, path)
    if buckets is None:
        raise FileNotFoundError(path)
    return _read(spark, f"{path}/buckets={buckets}").drop("bucket")


def read_buckets_of(asked: DataFrame, path: str, keys: list[str]) -> DataFrame:
    """The stored rows that lie in the buckets of the asked keys, any number of them.

    The filter names buckets, so other buckets' files are not opened; within a file rows
    are sorted by key. The rows of other keys in these buckets are still among the result.
    """
    spark = asked.sparkSession
    buckets = bucket_count(spark, path)
    if buckets is None:
        raise FileNotFoundError(path)
    stored = _read(spark, f"{path}/buckets={buckets}")
    return stored.filter(F.col("bucket").isin(_asked(asked, keys, buckets))).drop("bucket")
