"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.llm.common import tidy
from earshot.session import fixed

# Links that one task contracts in its memory.
BLOCK_LINKS = 500_000


def _with_least(pairs: DataFrame) -> DataFrame:
    """Each ``(node, other)`` with the least of the node and its others."""
    least = pairs.groupBy("node").agg(F.min("other").alias("least"))
    return pairs.join(least.select("node", F.least("node", "least").alias("least")), "node")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("a").alias("other"))
    )
    linked = _with_least(both).filter("other > node").select(F.col("other").alias("a"), F.col("least").alias("b"))
    return linked.filter("a <> b")


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("other"))
    met = _with_least(down)
    linked = met.select(F.col("other").alias("a"), F.col("least").alias("b")).unionByName(
        met.select(F.col("node").alias("a"), F.col("least").alias("b"))
    )
    return linked.filter("a <> b").distinct()


@tidy
def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of a block as stars around the least ids that the block itself connects."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while parent.setdefault(top, top) != top:
            top = parent[top]
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    nodes = [x for x in parent if root(x) != x]
    if nodes:
        yield pa.RecordBatch.from_arrays(
            [pa.array(nodes, pa.int64()), pa.array([parent[x] for x in nodes], pa.int64())], ["a", "b"]
        )


def components(edges: DataFrame) -> DataFrame:
    """``id, label`` of every node of the links ``a, b``; the label is the least id of the component.

    Blocks of ``BLOCK_LINKS`` are contracted by themselves first. Then both steps
    keep the components and bring the links closer to stars around the least ids,
    in a number of rounds that grows with the logarithm of the longest chain of
    blocks. Every round is written down. Links are slim rows; a hub's
    links are split by the join with its one row. No links give no rows.
    """
    links = fixed(edges.select(F.col("a").cast("long"), F.col("b").cast("long")).filter("a <> b"))
    blocks = max(1, math.ceil(links.count() / BLOCK_LINKS))
    current = fixed(links.repartition(blocks).mapInArrow(_contract, "a long, b long").distinct())
    mark = lambda df: tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_003)).head())
    before = mark(current)
    while True:
        current = fixed(_small_star(_large_star(current)))
        after = mark(current)
        if after == before:
            break
        before = after
    stars = current.select(F.col("a").alias("id"), F.col("b").alias("label"))
    centres = current.select(F.col("b").alias("id"), F.col("b").alias("label")).distinct()
    return stars.unionByName(centres)
