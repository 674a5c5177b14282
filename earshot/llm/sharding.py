"""Two-pass external shuffle into shards of equal row counts."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from earshot.llm.common import quoted, without
from earshot.session import scratch_path

RESULT = ("size", "shard", "slot")
# A bucket is shuffled in the memory of one task.
BUCKET_BYTES = 32 << 20


def shard_documents(
    docs: DataFrame, shards: int = 24, seed: int = 17, bucket_bytes: int = BUCKET_BYTES, path: str | None = None
) -> DataFrame:
    """Write all rows in random order into ``shards`` folders and read them back.

    Pass one scatters the rows uniformly by a seeded hash of id and text into
    buckets of about ``bucket_bytes``. Pass two brings each bucket into a fixed
    order, shuffles it by Fisher-Yates with a generator seeded by the bucket,
    and writes it: the buckets one after the other are one random order of all
    rows, and shard ``s`` is its ``s``-th part, so that row counts differ by one
    at most. A task that runs again writes the same rows to the same places.

    Result: the input's columns, ``size`` (UTF-8 bytes of the text, null: none,
    plus 8), ``shard`` and ``slot`` (place in the shard). Input columns named like
    these, or with a leading ``_shard``, are left out. Rows with a null id or text
    are rows like others, a very long text is one row; an empty table gives an empty result. Rows that agree in
    id and text stand in one bucket, which such a group alone can make larger.
    """
    spark = docs.sparkSession
    size = F.octet_length(F.coalesce(F.col("text"), F.lit(""))).cast("long") + F.lit(8)
    kept = [c for c in without(docs, *RESULT) if not c.lower().startswith("_shard")]
    # Plain names inside the job, the input's own in the files.
    plain = {f"_shard_column{i}": c for i, c in enumerate(kept)}
    names = {c.lower(): p for p, c in plain.items()}
    doc_id = names["doc_id"]
    sized = docs.select(
        *[quoted(c).alias(p) for p, c in plain.items()], size.alias("size"), F.xxhash64(F.lit(seed), "doc_id", "text").alias("_shard_hash")
    )
    total = sized.agg(F.sum("size")).head()[0] or 0
    buckets = max(math.ceil(total / bucket_bytes), int(spark.conf.get("spark.sql.shuffle.partitions")))
    scattered = sized.withColumn("_shard_bucket", F.pmod("_shard_hash", F.lit(buckets)).cast("int"))
    # One number per bucket, so as many as the input has memory-sized parts.
    counts = np.zeros(buckets, dtype=np.int64)
    for bucket, n in scattered.groupBy("_shard_bucket").count().toLocalIterator():
        counts[bucket] = n
    starts = np.concatenate([[0], np.cumsum(counts)])
    rows = int(starts[-1])

    def shuffle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        number = table["_shard_bucket"].to_numpy()
        for bucket in np.unique(number):
            own = table.filter(pc.equal(table["_shard_bucket"], int(bucket)))
            own = own.take(pc.sort_indices(own, [("_shard_hash", "ascending"), (doc_id, "ascending")]))
            dice = np.random.Generator(np.random.PCG64([seed, int(bucket)]))
            order = np.arange(own.num_rows)
            dice.shuffle(order)
            place = starts[bucket] + np.arange(own.num_rows)
            shard = place * shards // rows
            slot = place - (shard * rows + shards - 1) // shards
            own = own.take(pa.array(order)).drop_columns(["_shard_bucket", "_shard_hash"])
            own = own.append_column("slot", pa.array(slot, pa.int64()))
            own = own.append_column("shard", pa.array(shard.astype(np.int32), pa.int32()))
            yield from own.to_batches(max_chunksize=4096)

    fields = [f for f in sized.schema.fields if f.name != "_shard_hash"]
    schema = StructType([*fields, StructField("slot", LongType()), StructField("shard", IntegerType())])
    path = path or scratch_path(spark, "shards")
    shuffled = scattered.repartitionById(buckets, F.col("_shard_bucket")).mapInArrow(shuffle, schema)
    named = shuffled.select(*[F.col(c).alias(plain.get(c, c)) for c in shuffled.columns])
    named.write.partitionBy("shard").parquet(path)
    return spark.read.schema(named.schema).parquet(path)
