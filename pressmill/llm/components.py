"""Connected components of an edge table by alternating stars."""

import pyarrow as pa
from pyspark.sql import functions as F

from pressmill.llm.common import cut, keep


def _forests(batches):
    """Replaces the edges of a batch by a spanning forest that points at the smallest node."""
    for batch in batches:
        parent = {}

        def root(x):
            while parent.setdefault(x, x) != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
        out = [(x, root(x)) for x in parent if root(x) != x]
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()),
                                          pa.array([r for _, r in out], pa.int64())], ["u", "v"])


def _marks(df):
    return df.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h")).first()


def components(edges):
    """(node, root) for every node of ``edges`` (columns u, v: long, no nulls needed); root is
    the smallest node that can be reached.

    A node's smallest neighbour comes from a partial aggregate, is written and joined back, so that
    adaptive execution can split the neighbours of a hub. Each round ends in a checkpoint; the number of
    rounds grows with the logarithm of the longest path. No edges: an empty result.
    """
    now = cut(edges.where("u <> v").mapInArrow(_forests, "u long, v long").distinct())
    before = None
    while (mark := _marks(now)) != before:
        before = mark
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = keep(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = keep(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = cut(small.unionAll(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
    roots = now.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("node"), "root")
    return roots.unionAll(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
