"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterline.llm.common import written

#: Edges that one task reduces to a forest.
TASK_EDGES = 500_000


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edges' components as edges to their least node: one a node at most."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while parent.setdefault(root, root) != root:
            root = parent[root]
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    for batch in batches:
        for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist()):
            a, b = find(u), find(v)
            if a != b:
                parent[max(a, b)] = min(a, b)
    rows = [(x, find(x)) for x in parent if find(x) != x]
    for at in range(0, len(rows), 50_000):
        cols = zip(*rows[at : at + 50_000])
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["u", "v"])


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (u, v); root is the least node reachable.

    First each task reduces TASK_EDGES edges to a forest, which keeps what is
    connected and has no more edges than nodes; edges that fit one task are done.
    Beyond that, each round hangs a node's larger neighbours on its least neighbour, then its
    smaller ones; the rounds needed grow with the logarithm of the longest path.
    Minima are summed before the shuffle, the join back may split a hot node, and
    each round is written to the shared folder, which bounds the lineage.
    """
    now = edges.where("u <> v")
    tasks = 1 + now.count() // TASK_EDGES
    now = written(now.coalesce(tasks).mapInArrow(_forest, "u long, v long").distinct(), "edges")
    mark = _mark(now) if tasks > 1 else (0,)
    while mark[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(least, "u").select(F.explode(F.array(
            F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v"))
        )).alias("e")).select("e.u", "e.v")
        now = written(hung.where("u <> v").distinct(), "edges")
        before, mark = mark, _mark(now)
        if mark == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def _mark(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
    return tuple(r)
