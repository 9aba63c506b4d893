"""Connected components: by union-find in one task while edges are few, else by alternating large stars and small stars (Kiveris et al. 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import checkpointed


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link each node's larger (large star) or smaller (small star) neighbours to the least node about it."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    linked = both.join(least, "a")
    if large:
        return linked.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    return linked.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


#: Edges that one task joins; beyond it they stay distributed.
TASK_EDGES = 500_000


def _joined(batches):
    """Union-find over all edges of a task; the lesser root wins."""
    import pyarrow as pa

    parent: dict = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    kind = None
    for batch in batches:
        kind = batch.column(0).type
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = find(a), find(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    if parent:
        yield pa.RecordBatch.from_arrays([pa.array(list(parent), kind), pa.array([find(x) for x in parent], kind)], names=["node", "root"])


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """Edges (a, b) of any orderable type to (node, root), root the least node reachable; nodes without edges aren't listed.

    Counts and minima are gathered before rows move and the joins are plain, so a node with very many
    neighbours is split by Spark's skew join. Loops and repeated edges do no harm; no edges give no rows.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    edges = checkpointed(edges)
    if edges.count() <= TASK_EDGES:
        kind = edges.schema["a"].dataType.simpleString()
        return edges.coalesce(1).mapInArrow(_joined, f"node {kind}, root {kind}")
    seen = None
    for _ in range(most_rounds):
        edges = checkpointed(_star(_star(edges, True), False))
        mark = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(mark) == seen:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        seen = tuple(mark)
    raise RuntimeError("components did not settle")
