"""Connected components over an edge table, by repeated contraction."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kairo.session import materialize as _materialize
from kairo.session import release

# ids and hashes do not compress
materialize = partial(_materialize, compressed=False)



def connected_components(edges: DataFrame) -> DataFrame:
    """``edges(a, b)`` of longs to ``(id, component)``: the smallest id that
    each id reaches.  Ids without an edge are not in the result.

    Every round hooks each node to its smallest neighbour, shortens the
    resulting trees to their roots by pointer doubling, and contracts the
    edges to the roots.  Each table is written to the shared checkpoint
    folder, so a lost executor costs one round; nothing is collected.
    """
    left, n = materialize(edges.filter("a <> b").select("a", "b").distinct(), "cc-edges")
    size = n
    ids = left.select(F.col("a").alias("id")).union(left.select("b")).distinct()
    labels, _ = materialize(ids.select("id", F.col("id").alias("component")), "cc-labels", rows=2 * n)
    while n:
        both = left.union(left.select("b", "a"))
        roots, _ = materialize(
            both.groupBy("a").agg(F.least("a", F.min("b")).alias("p"))
                .select(F.col("a").alias("x"), "p"), "cc-roots", rows=2 * n)
        while True:
            up = roots.select(F.col("x").alias("p"), F.col("p").alias("q"))
            shorter, _ = materialize(roots.join(up, "p").select(
                "x", F.col("q").alias("p"), (F.col("q") != F.col("p")).alias("moved")), "cc-roots",
                rows=2 * n)
            moved = not shorter.filter("moved").isEmpty()
            release(roots)
            roots = shorter.drop("moved")
            old = shorter
            if not moved:
                break
        to_a = roots.select(F.col("x").alias("a"), F.col("p").alias("ra"))
        to_b = roots.select(F.col("x").alias("b"), F.col("p").alias("rb"))
        next_left, n = materialize(
            left.join(to_a, "a").join(to_b, "b").filter("ra <> rb")
                .select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct(), "cc-edges", rows=n)
        to = roots.select(F.col("x").alias("component"), "p")
        next_labels, _ = materialize(
            labels.join(to, "component", "left")
                  .select("id", F.coalesce("p", "component").alias("component")), "cc-labels",
            rows=2 * size)
        release(left, labels, old)
        left, labels = next_left, next_labels
    release(left)
    return labels
