"""Surrogate ids computed from natural keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hash_id(*cols: Column) -> Column:
    """Stable 64-bit id; needs no global numbering and is the same in every run."""
    return F.xxhash64(*cols)


def id_collisions(df: DataFrame, id_col: str, key: Column) -> DataFrame:
    """Ids that stand for more than one natural key."""
    return (
        df.select(F.col(id_col), key.alias("_key"))
        .groupBy(id_col)
        .agg(F.min("_key").alias("first_key"), F.max("_key").alias("last_key"))
        .filter(F.col("first_key") != F.col("last_key"))
    )


def require_distinct_ids(df: DataFrame, id_col: str, key: Column) -> DataFrame:
    """Fail the load when two natural keys share an id."""
    clash = id_collisions(df, id_col, key).head(1)
    if clash:
        raise ValueError(f"{id_col} {clash[0][0]} stands for two keys: {clash[0][1]!r}, {clash[0][2]!r}")
    return df
