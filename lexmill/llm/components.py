"""Connected components by repeated contraction with DataFrame operations, and in one task once few edges are left."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm._common import written

#: Edges (16 bytes each) up to which one task finds the components that are left; each round of contraction is a dozen small stages.
FEW_EDGES = 200_000


def smallest_reachable(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of the edges, ascending, and the smallest node that each reaches."""
    nodes, place = np.unique(np.concatenate([u, v]), return_inverse=True)
    u, v = place[: len(u)], place[len(u) :]
    top = np.arange(len(nodes))
    while len(u):
        np.minimum.at(top, np.maximum(u, v), np.minimum(u, v))  # tops only: all others point to a smaller place already
        while (top[top] != top).any():
            top = top[top]
        u, v = top[u], top[v]
        apart = u != v
        u, v = u[apart], v[apart]
    return nodes, nodes[top]


def _in_one_task(edges: DataFrame) -> DataFrame:
    """(node, p) of all nodes of edges (u, v); p is the smallest node reachable."""

    def run(batches):
        import pyarrow as pa

        held = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in smallest_reachable(*(np.concatenate(x) for x in zip(*held)))], names=["node", "p"])

    return edges.select("u", "v").coalesce(1).mapInArrow(run, "node bigint, p bigint")


def connected_components(edges: DataFrame, folder: str, name: str = "cc") -> DataFrame:
    """(node, component) of every node of edges(a, b); component is the smallest node reachable.

    Each round points every node to its smallest neighbour, follows those pointers twice,
    relabels the edges and drops those inside one label. The node count at least halves in
    expectation, stars end in one round, and a hub costs one row a map task because minima
    are combined before the shuffle. Edges that a task can hold end there, whatever the first
    number was. Nodes are bigint. Null ends and loops are ignored; no edges, no rows.
    """
    edges = edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = written(edges, folder, f"{name}-edges-0")
    levels: list[DataFrame] = []
    step = 0
    while many := edges.count():
        step += 1
        if many <= FEW_EDGES:
            levels.append(written(_in_one_task(edges), folder, f"{name}-label-{step}"))
            break
        ends = edges.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.col("v").alias("to")), F.struct(F.col("v").alias("node"), F.col("u").alias("to")))).alias("e")).select("e.*")
        parent = ends.groupBy("node").agg(F.min("to").alias("to")).select("node", F.least("node", "to").alias("p"))
        parent = written(parent, folder, f"{name}-parent-{step}")
        for hop in range(2):
            nxt = parent.select(F.col("node").alias("p"), F.col("p").alias("q"))
            parent = parent.join(nxt, "p").select("node", F.col("q").alias("p"))
        parent = written(parent, folder, f"{name}-label-{step}")
        pu = parent.select(F.col("node").alias("u"), F.col("p").alias("pu"))
        pv = parent.select(F.col("node").alias("v"), F.col("p").alias("pv"))
        edges = edges.join(pu, "u").join(pv, "v").where("pu <> pv").select(F.greatest("pu", "pv").alias("u"), F.least("pu", "pv").alias("v")).distinct()
        edges = written(edges, folder, f"{name}-edges-{step}")
        levels.append(parent)
    if not levels:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).limit(0)
    label = levels.pop().select("node", F.col("p").alias("component"))
    if not levels:
        return label
    while levels:  # from the last round back, whose nodes are few: each round's nodes are joined once
        up = label.select(F.col("node").alias("p"), F.col("component").alias("up"))
        label = levels.pop().join(up, "p", "left").select("node", F.coalesce("up", "p").alias("component"))
    return written(label, folder, f"{name}-components")
