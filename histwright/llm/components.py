"""Connected components of a link table, as Spark jobs.

Links are dealt evenly, also those of one node. Each round runs a union-find inside every
partition (which leaves at most one link for each node there), then a large-star and a small-star step over the whole table.
Links are halved or better from round to round until every node points at its
component's smallest one. All rounds are written to the shared folder; only counts and checksums
reach the driver. A node with very many links is a group-by on its id with
map-side minima, never a collected list.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

#: Links that one task holds in its union-find.
LINKS_PER_TASK = 200_000


def local_forest(links: DataFrame) -> DataFrame:
    """Union-find over each partition: every node's link to its smallest one there."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            top = x
            while (up := parent.setdefault(top, top)) != top:
                top = up
            while parent[x] != top:
                parent[x], x = top, parent[x]
            return top

        for batch in batches:
            for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                a, b = root(u), root(v)
                if a != b:
                    parent[max(a, b)] = min(a, b)
        nodes = [x for x in list(parent) if root(x) != x]
        for i in range(0, len(nodes), 50_000):
            part = nodes[i:i + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()),
                                              pa.array([root(x) for x in part], pa.int64())], ["u", "v"])

    return links.select("u", "v").mapInArrow(run, "u long, v long")


def large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node links to the node's smallest neighbour."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return (both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v").distinct())


def small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours link to the smallest of them."""
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u")
    return (moved.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct())


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node with a link; root is the smallest node it reaches."""
    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")),
                            F.countDistinct("u")).first())

    def forest(df: DataFrame, n: int) -> DataFrame:
        # Sized by rows, so that a round over few links is not hundreds of near-empty tasks. Dealt by the
        # whole link: by one end, a star's links would all be one task's.
        tasks = -(-n // LINKS_PER_TASK)
        return materialize(local_forest(df.repartition(tasks, "u", "v") if tasks > 1 else df.coalesce(1)), "cc-forest")

    now = materialize(links.where("u <> v").select("u", "v").distinct(), "cc-links")
    n = now.count()
    now = forest(now, n)
    if n <= LINKS_PER_TASK:  # one partition's forest is the answer
        return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    seen = state(now)
    while True:
        now = forest(materialize(small_star(large_star(now)), "cc"), seen[0])
        after = state(now)
        if after == seen and after[0] == after[2]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = after
