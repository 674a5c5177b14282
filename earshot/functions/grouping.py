"""Group-wise building blocks that do not put one hot group into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from earshot.session import fixed

# A cut to this many rows per task leaves little of a hot group: even from
# 100,000 tasks a few million rows come together, which one task can sort.
FEW_ROWS = 64


def ordered_concat(
    df: DataFrame, keys: Sequence[str], pos: str, text: str, sep: str, out: str, block: int = 1024
) -> DataFrame:
    """Join ``text`` per group in ``pos`` order; NULL texts are left out.

    Two levels: blocks of ``block`` positions are sorted and joined in parallel,
    so a hot group's rows spread over tasks and only its finished blocks meet.
    """
    quoted = sep.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n")
    keep = [F.col(k) for k in keys]
    blocks = (
        df.select(*keep, F.col(pos).alias("_pos"), F.col(text).alias("_text"))
        .withColumn("_block", F.floor(F.col("_pos") / block))
        .groupBy(*keys, "_block")
        .agg(F.expr(f"listagg(_text, '{quoted}') WITHIN GROUP (ORDER BY _pos)").alias("_text"))
    )
    return blocks.groupBy(*keys).agg(
        F.expr(f"listagg(_text, '{quoted}') WITHIN GROUP (ORDER BY _block)").alias(out)
    )


def running_total(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], value: Column, out: str, inclusive: bool = True
) -> DataFrame:
    """Running sum of ``value`` per group, in ``order`` (which must be unique per group).

    Unless ``inclusive``, the sum of the rows strictly before.

    Rows are range-partitioned over group and order, so a hot group spans many
    partitions. Each partition sums its own stretch; the stretch totals (one
    row per group and partition) supply what came before. The placed rows are
    written down because the stretch number must not change when a lost task
    is run again.
    """
    ordering = {f"_order{i}": c for i, c in enumerate(order)}
    # One struct as group key: NULL keys form a group and all steps share one exchange.
    group = F.struct(*[F.col(k) for k in keys]).alias("_group") if keys else F.struct(F.lit(0).alias("all"))
    placed = fixed(
        df.withColumns({**ordering, "_value": value, "_group": group})
        .repartitionByRange("_group", *ordering)
        .withColumn("_stretch", F.spark_partition_id())
    )
    totals = placed.groupBy("_group", "_stretch").agg(F.sum("_value").alias("_total"))
    before = Window.partitionBy("_group").orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_group", "_stretch", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_offset")
    )
    inside = (
        Window.partitionBy("_group", "_stretch")
        .orderBy(*ordering)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow if inclusive else -1)
    )
    return (
        placed.withColumn("_local", F.coalesce(F.sum("_value").over(inside), F.lit(0)))
        .join(offsets, ["_group", "_stretch"])
        .withColumn(out, F.col("_local") + F.col("_offset"))
        .select(*df.columns, out)
    )


def top_n(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    n: int,
    salt_by: Sequence[str],
    rank: str = "rank",
    salts: int = 64,
) -> DataFrame:
    """The first ``n`` rows per group with their ``rank``.

    Tasks cut groups to ``n`` rows before they shuffle, so a hot group sends at
    most ``n`` rows from each task to one place. That is little for a small
    ``n``. For a larger one groups are cut in ``salts`` parts (by the columns
    ``salt_by``) first, and the parts' winners meet after that.
    """
    if n > FEW_ROWS:
        part = F.pmod(F.xxhash64(*salt_by), F.lit(salts))
        in_part = Window.partitionBy(*keys, "_part").orderBy(*order)
        df = (
            df.withColumn("_part", part)
            .withColumn("_place", F.row_number().over(in_part))
            .filter(F.col("_place") <= n)
            .drop("_part", "_place")
        )
    in_group = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(in_group)).filter(F.col(rank) <= n)


def first_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], carry: Sequence[str]
) -> DataFrame:
    """One row per group, the first in ``order``; partial aggregates make hot groups cheap."""
    picked = F.min(F.struct(*order, *[c for c in carry if c not in order])).alias("_first")
    names = list(dict.fromkeys([*order, *carry]))
    return df.groupBy(*keys).agg(picked).select(*keys, *[F.col(f"_first.{n}") for n in names])


def mark_existing(df: DataFrame, keys: DataFrame, on: Sequence[str], out: str) -> DataFrame:
    """Add a boolean column telling whether the key occurs in ``keys``."""
    known = keys.select(*on).distinct().withColumn(out, F.lit(True))
    return df.join(known, list(on), "left").withColumn(out, F.coalesce(F.col(out), F.lit(False)))
