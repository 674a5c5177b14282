"""Computing an expression once although it is used more than once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once.

    As argument of a lambda it is bound to a variable; named columns would be
    put in place of each use when the optimizer merges projections.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def compute_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns that later filters read without computing them again.

    They come out of a one-row generator, below which no filter is pushed.
    """
    record = F.struct(*[value.alias(name) for name, value in columns.items()])
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, F.inline(F.array(record)))
