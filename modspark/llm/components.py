"""Connected components of a table of links: union-find inside tasks, then min-label stars in rounds of joins."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modspark.llm.store import saved

SALTS = 16
"""Neighbours of a node are dealt out to so many tasks when they learn its smallest one."""
FLUSH_LINKS = 1 << 18
"""A task joins links to groups in memory up to this many before it hands them on."""


class UnionFind:
    """Groups of the numbers 0 to n - 1; the root of a group is its smallest member."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def root(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def union(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        self.parent[max(x, y)] = min(x, y)
        return x != y


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label): the smallest node that the links reach, for every node that has a link.

    Each task first joins its own links by union-find and hands on one link per node that
    joined, to the group's smallest; the tasks that get all links to a larger end do so
    again. What is left between tasks is joined in rounds, until the links are stars around
    the smallest nodes. Each round replaces the links by stars around the smallest
    neighbour: first every node points its larger neighbours to its smallest one, then its
    smaller ones. Links never grow in number, and the rounds are logarithmic in the longest
    chain.
    """
    both = links.select(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi")).filter("lo <> hi")
    now = saved(_contracted(_contracted(both).repartition("hi")))
    while not _stars_only(now):
        large = _star(now.union(now.select("hi", "lo")).toDF("n", "m"), larger_only=True)
        now = saved(_star(large.select("hi", "lo").toDF("n", "m"), larger_only=False))
    ends = now.select(F.col("hi").alias("node"), F.col("lo").alias("label"))
    return ends.union(now.select("lo", "lo").distinct())


def _contracted(links: DataFrame) -> DataFrame:
    """Links (lo, hi) that connect what the links connect, at most as many: stars of the tasks' groups."""

    def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= FLUSH_LINKS:
                yield _stars(held)
                held, size = [], 0
        if size:
            yield _stars(held)

    return links.mapInArrow(contract, links.schema)


def _stars(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    pairs = [(a, b) for batch in held for a, b in zip(*(batch.column(i).to_pylist() for i in (0, 1)), strict=True)]
    names = sorted({x for pair in pairs for x in pair})
    number = {x: i for i, x in enumerate(names)}
    groups = UnionFind(len(names))
    for a, b in pairs:
        groups.union(number[a], number[b])
    stars = [(names[groups.root(i)], x) for i, x in enumerate(names) if groups.root(i) != i]
    return pa.RecordBatch.from_arrays(
        [pa.array([s[i] for s in stars], held[0].schema.field(i).type) for i in (0, 1)], names=["lo", "hi"]
    )


def _stars_only(links: DataFrame) -> bool:
    """Whether every larger end has one link and is no smaller end of another: nothing is left to join."""
    ends = links.select(F.col("hi").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.union(links.select("lo", F.lit(0), F.lit(1)))
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not nodes.agg(F.max(F.expr("up + down > 1 and up > 0"))).first()[0]


def _star(pairs: DataFrame, larger_only: bool) -> DataFrame:
    """Point neighbours m of every node n to the smallest of n and its neighbours.

    A node's neighbours are aggregated in parts, and meet the result in parts.
    """
    least = pairs.groupBy("n").agg(F.least("n", F.min("m")).alias("root"))
    salt = F.pmod(F.xxhash64("m"), F.lit(SALTS)).cast("int").alias("salt")
    known = least.select("n", "root", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    linked = pairs.select("n", "m", salt).join(known, ["n", "salt"])
    if larger_only:
        linked = linked.filter("m > n")
        out = linked.select(F.col("root").alias("lo"), F.col("m").alias("hi"))
    else:
        own = least.select(F.col("root").alias("lo"), F.col("n").alias("hi"))
        out = linked.select(F.col("root").alias("lo"), F.col("m").alias("hi")).union(own)
    return out.filter("lo <> hi").distinct()
