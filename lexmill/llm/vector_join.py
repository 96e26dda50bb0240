"""Exact range join of vectors by cosine: pivots, the triangle inequality, independent cells.

On the unit sphere the angle is a metric, and cosine >= c is angle <= r. Every vector lives
in the cell of its nearest pivot. A vector y linked to x of cell i has, by the triangle
inequality, angle(y, p_i) <= angle(y, p_home(y)) + 2 r and <= angle(x, p_i) + r; y therefore
visits every cell that passes both, the second with the cell's radius. Of two cells that
two vectors may meet in, only one compares them (the parity of the two numbers decides), so
each cell does its share alone: residents against residents, and against its visitors.

Cells with many residents are split into blocks, and residents of the other blocks come as
visitors. A block counts links of both sides and reports a spanning forest of what it links,
never the pairs. Equal vectors are one class with a count. Vectors that have no direction to
prune by (uniform noise in many dimensions) visit all cells; then this is all pairs in blocks.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm._common import work_dir, written
from lexmill.llm.components import connected_components

#: Residents of a block, pivots at most, visitors compared at a time, slack of angles in rounding.
BLOCK, PIVOTS, VISITORS, SLACK = 1024, 1024, 2048, 1e-6


def matrix(values) -> np.ndarray:
    """An Arrow list array as rows of doubles, padded with zeros."""
    flat, at = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64), values.offsets.to_numpy()
    n = np.diff(at)
    if len(n) and (n == n[0]).all():
        return flat.reshape(len(n), -1) if n[0] else np.zeros((len(n), 1))
    out = np.zeros((len(n), int(n.max(initial=1)) or 1))
    for i, (a, b) in enumerate(zip(at, at[1:])):
        out[i, : b - a] = flat[a - at[0] : b - at[0]]
    return out


def unit(x: np.ndarray, width: int) -> np.ndarray:
    x = np.pad(x, ((0, 0), (0, max(0, width - x.shape[1]))))
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def meets(i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether cell i, of cells i and j, is where their vectors are compared."""
    return np.where((i + j) % 2 == 0, i < j, i > j)


def nearest_cells(classes: DataFrame, pivots: np.ndarray) -> DataFrame:
    """classes with home and turn (angle to the home pivot)."""
    shared = classes.sparkSession.sparkContext.broadcast(pivots)

    def run(batches):
        import pyarrow as pa

        p = shared.value
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                own = batch.slice(lo, 4096)
                turn = np.arccos(np.clip(unit(matrix(own.column(1)), p.shape[1]) @ p.T, -1, 1))
                home = turn.argmin(axis=1)
                yield pa.RecordBatch.from_arrays([*own.columns, pa.array(home, pa.int32()), pa.array(turn[np.arange(len(home)), home])], names=["rep", "embedding", "copies", "home", "turn"])

    return classes.select("rep", "embedding", "copies").mapInArrow(run, f"rep bigint, embedding {dict(classes.dtypes)['embedding']}, copies bigint, home int, turn double")


def visits(homed: DataFrame, pivots: np.ndarray, blocks: np.ndarray, radius: np.ndarray, r: float) -> DataFrame:
    """(cell, block, resident, home, rep, copies, embedding): every vector in its block and in all that it visits."""
    spark = homed.sparkSession
    shared = spark.sparkContext.broadcast((pivots, blocks, radius))

    def run(batches):
        import pyarrow as pa

        p, blocks, radius = shared.value
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                own = batch.slice(lo, 1024)
                rep = own.column(0).to_numpy()
                home = own.column(3).to_numpy()
                turn = np.arccos(np.clip(unit(matrix(own.column(1)), p.shape[1]) @ p.T, -1, 1))
                reach = (turn <= own.column(4).to_numpy()[:, None] + 2 * r + SLACK) & (turn <= radius + r + SLACK)
                reach &= meets(np.arange(len(p))[None, :], home[:, None])
                reach[np.arange(len(home)), home] = True
                row, cell = np.nonzero(reach)
                row, cell = np.repeat(row, blocks[cell]), np.repeat(cell, blocks[cell])
                first = np.r_[True, (np.diff(row) != 0) | (np.diff(cell) != 0)]
                block = np.arange(len(row)) - np.maximum.accumulate(np.where(first, np.arange(len(row)), 0))
                own_block = rep[row].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)
                resident = (cell == home[row]) & (own_block % blocks[cell].astype(np.uint64) == block.astype(np.uint64))
                keep = resident | (cell != home[row]) | meets(block, own_block % blocks[cell].astype(np.uint64).astype(np.int64)).astype(bool)
                row, cell, block, resident = row[keep], cell[keep], block[keep], resident[keep]
                taken = own.take(pa.array(row))
                yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int32()), pa.array(block, pa.int32()), pa.array(resident), taken.column(0), taken.column(2), taken.column(1)], names=["cell", "block", "resident", "rep", "copies", "embedding"])

    return homed.mapInArrow(run, f"cell int, block int, resident boolean, rep bigint, copies bigint, embedding {dict(homed.dtypes)['embedding']}")


def linked_in_cells(visiting: DataFrame, width: int, least: float) -> DataFrame:
    """(rep, other, weight): the copies linked to rep, other null, and edges of a forest, weight null."""

    def run(batches):
        import pyarrow as pa

        key, x, ids, copies, wait = None, None, None, None, []

        def sent(a, w):
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.nulls(len(a), pa.int64()), pa.array(w, pa.int64())], names=["rep", "other", "weight"])

        def forest(a, b):
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.nulls(len(a), pa.int64())], names=["rep", "other", "weight"])

        def among(own, other, own_copies, other_copies, same):
            """Links of own to other rows: (weights of own, weights of other, which are close)."""
            close = own @ other.T >= least
            if same:
                np.fill_diagonal(close, False)
            return close @ other_copies, own_copies @ close, close

        def tops(close):
            """The smallest row that each row reaches, by repeated minima over its links."""
            top = np.arange(len(close))
            some = np.flatnonzero(close.any(axis=1))
            near = close[some]
            while len(some):
                least = np.minimum(top[some], np.where(near, top, len(top)).min(axis=1))
                new = top.copy()
                new[some] = least
                np.minimum.at(new, top[some], least)
                new = new[new]
                if (new == top).all():
                    break
                top = new
            return top

        def settle():
            """Residents against each other."""
            weight, _, close = among(x, x, copies, copies, True)
            top = tops(close)
            some, tied = np.flatnonzero(weight), np.flatnonzero(top != np.arange(len(top)))
            return top, [sent(ids[some], weight[some]), forest(ids[tied], ids[top[tied]])]

        def visited(top, rows):
            y, other, n = rows
            weight, back, close = among(x, y, copies, n, False)
            j, i = np.nonzero(close.T)
            both = np.unique(j * len(ids) + top[i])  # each visitor with each of the block's groups that it meets
            some, more = np.flatnonzero(weight), np.flatnonzero(back)
            return [sent(np.r_[ids[some], other[more]], np.r_[weight[some], back[more]]), forest(other[both // len(ids)], ids[both % len(ids)])]

        parent = None

        def close_block():
            nonlocal parent, x, ids, copies, wait
            out = []
            if wait and x is None:
                x, ids, copies = (np.concatenate([w[i] for w in wait]) for i in range(3))
                wait = []
                parent, out = settle()
            parent, x, ids, copies, wait = None, None, None, None, []
            return out

        for batch in batches:
            if not batch.num_rows:
                continue
            cell, block, resident = (np.asarray(batch.column(i)) for i in range(3))
            edge = np.flatnonzero(np.r_[True, (np.diff(cell) != 0) | (np.diff(block) != 0) | (resident[1:] != resident[:-1])])
            for a, b in zip(edge, [*edge[1:], batch.num_rows]):
                if key != (own := (cell[a], block[a])):
                    yield from close_block()
                    key = own
                part = batch.slice(a, b - a)
                rows = unit(matrix(part.column(5)), width), part.column(3).to_numpy(), part.column(4).to_numpy()
                if resident[a]:
                    wait.append(rows)
                    continue
                if x is None and wait:
                    x, ids, copies = (np.concatenate([w[i] for w in wait]) for i in range(3))
                    wait = []
                    parent, out = settle()
                    yield from out
                if x is not None:
                    for lo in range(0, len(rows[0]), VISITORS):
                        yield from visited(parent, tuple(c[lo : lo + VISITORS] for c in rows))
        yield from close_block()

    return visiting.mapInArrow(run, "rep bigint, other bigint, weight bigint")


def similar_vectors(vectors: DataFrame, least: float = 0.9, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row, by cosine >= least in double precision.

    n_links counts the other rows linked directly, component_id is the smallest vec_id
    reachable, kept says whether that is the row's own. Null and zero vectors and those with
    null or non-finite components link with nothing; shorter vectors count as ending in
    zeros. A null vec_id takes no part and gets no links and a null component_id. Rows that
    repeat a vec_id are vectors of their own; equal ones link with each other. Other columns
    of any name are left out, and an empty table stays empty.
    """
    spark = vectors.sparkSession
    folder = work_dir(spark)
    kind = "array<float>" if dict(vectors.dtypes)[embedding] == "array<float>" else "array<double>"
    rows = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(embedding).cast(kind).alias("embedding"))
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists("embedding", lambda v: v != 0)
    rows = rows.withColumn("usable", F.coalesce(F.col("vec_id").isNotNull() & finite, F.lit(False)))
    classes = rows.where("usable").groupBy("embedding").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"))
    classes = written(classes.withColumn("rep", F.monotonically_increasing_id()), folder, "classes")  # one vec_id may name several vectors
    size = classes.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("embedding")).alias("width")).first()
    if not size.n:
        return rows.select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"))
    many = min(PIVOTS, max(1, math.isqrt(size.n) // 8))
    chosen = classes.orderBy(F.xxhash64("least"), "least", "embedding").limit(many).select(F.col("embedding").cast("array<double>").alias("e")).collect()  # at most PIVOTS
    pivots = np.zeros((len(chosen), size.width))
    for i, row in enumerate(chosen):
        pivots[i, : len(row.e)] = row.e
    pivots = unit(pivots, size.width)
    homed = written(nearest_cells(classes, pivots), folder, "homed")
    blocks, radius = np.ones(len(pivots), np.int64), np.zeros(len(pivots))
    for c in homed.groupBy("home").agg(F.count(F.lit(1)).alias("n"), F.max("turn").alias("r")).collect():  # a row a pivot
        blocks[c.home], radius[c.home] = -(-c.n // BLOCK), c.r
    r = math.acos(max(-1.0, min(1.0, least)))
    visiting = visits(homed, pivots, blocks, radius, r)
    visiting = visiting.repartition("cell", "block").sortWithinPartitions("cell", "block", F.desc("resident"))
    links = written(linked_in_cells(visiting, size.width, least), folder, "links")
    counts = links.where("other is null").groupBy("rep").agg(F.sum("weight").alias("weight"))
    labels = connected_components(links.where("other is not null").select(F.col("rep").alias("a"), F.col("other").alias("b")), folder)
    info = classes.join(counts, "rep", "left").join(labels.withColumnRenamed("node", "rep"), "rep", "left")
    info = info.select("embedding", "least", "component", (F.col("copies") - 1 + F.coalesce("weight", F.lit(0))).alias("links"))
    names = info.where("component is not null").groupBy("component").agg(F.min("least").alias("comp"))
    info = info.join(names, "component", "left").select("embedding", "links", F.coalesce("comp", "least").alias("comp"))
    alone = rows.where("not usable").select("vec_id", F.lit(0).cast("bigint").alias("links"), F.col("vec_id").alias("comp"))
    out = rows.where("usable").select("vec_id", "embedding").join(info, "embedding").select("vec_id", "links", "comp").unionByName(alone)
    return out.select("vec_id", F.col("links").alias("n_links"), F.col("comp").alias("component_id"), F.coalesce(F.col("vec_id") == F.col("comp"), F.lit(False)).alias("kept"))
