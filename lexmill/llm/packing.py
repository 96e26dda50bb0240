"""Best-fit packing of token sequences by exact complements of lengths.

What goes into a sequence depends on lengths only, so the plan is made on the histogram of
lengths (at most max_len rows, whatever the corpus): the largest length left is combined with
a single, a pair or a triple that fills its gap exactly, as often as the counts allow, and
best fit takes what has no exact complement. Pieces are ranked within their length by a
sum over (length, task) counts, so that no length's pieces meet in one task, and find their
place by a search in the plan, whose size is bounded by max_len.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexmill.llm._common import work_dir, written
from lexmill.llm.tokens import encoder, forget

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids binary, part int, nth bigint"


def token_pieces(docs: DataFrame, file: str, max_len: int = 4096, end_id: int = 1) -> DataFrame:
    """Each document's ids, the end id after them, cut into pieces of max_len ids; the last may be shorter.

    A null or empty text gives one piece that holds the end id alone. ids are little-endian
    unsigned 32-bit integers. (part, nth) number the pieces of each length within a task.
    """

    def pieces(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        part, encode, seen = TaskContext.get().partitionId(), encoder(file), np.zeros(max_len + 1, np.int64)
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            doc_ids, texts = (batch.column(i).to_pylist() for i in (0, 1))
            for lo in range(0, len(texts), 2000):
                rows: tuple[list, ...] = ([], [], [], [], [], [], [])
                for doc_id, ids in zip(doc_ids[lo : lo + 2000], encode(texts[lo : lo + 2000])):
                    ids += end
                    for piece, at in enumerate(range(0, len(ids), 4 * max_len)):
                        own = ids[at : at + 4 * max_len]
                        n = len(own) // 4
                        for column, value in zip(rows, (doc_id, piece, at // 4, n, own, part, int(seen[n]))):
                            column.append(value)
                        seen[n] += 1
                types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, types)], names=["doc_id", "piece", "start", "length", "ids", "part", "nth"])

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(pieces, PIECES)


def _pair(left: np.ndarray, gap: int) -> tuple[int, int] | None:
    """Two lengths that sum to gap, of those left; the most plentiful."""
    if gap < 2:
        return None
    half = np.arange(1, gap // 2 + 1)
    have = np.minimum(left[half], left[gap - half])
    if gap % 2 == 0:
        have[-1] = left[gap // 2] // 2
    best = int(have.argmax())
    return (gap - 1 - best, best + 1) if have[best] > 0 else None


class _Sums:
    """Which sums two of the lengths left can have; kept until a length runs out."""

    def __init__(self, left: np.ndarray):
        self.some, self.size = None, 1 << (2 * len(left) - 1).bit_length()

    def of(self, left: np.ndarray) -> np.ndarray:
        some = left > 0
        if self.some is None or not np.array_equal(some, self.some):
            self.some = some
            f = np.fft.rfft(some.astype(float), self.size)
            self.two = np.fft.irfft(f * f, self.size)[: len(left)] > 0.5
        return self.two


def _exact(left: np.ndarray, gap: int, sums: _Sums) -> list[int] | None:
    """One, two or three lengths left that sum to gap."""
    if gap < len(left) and left[gap] > 0:
        return [gap]
    if (two := _pair(left, gap)) is not None:
        return list(two)
    if gap < 3:
        return None
    pairs = sums.of(left)
    first = np.arange(gap - 2, 0, -1)
    for a in first[(left[first] > 0) & pairs[gap - first]]:
        left[a] -= 1
        two = _pair(left, gap - int(a))
        left[a] += 1
        if two is not None:
            return [int(a), *two]
    return None


def pack_plan(counts: dict[int, int], max_len: int) -> list[tuple[int, int, int, int, int]]:
    """Runs (length, first rank, how many, first sequence, offset) that place every piece.

    The r-th piece of a length, in the run with first rank f <= r < f + how many, goes to
    sequence (first sequence + r - f) at offset. The number of runs depends on the number
    of distinct lengths, not on the number of pieces.
    """
    left = np.zeros(max_len + 1, np.int64)
    for n, c in counts.items():
        left[n] = c
    used, runs, sequence, sums = np.zeros(max_len + 1, np.int64), [], 0, _Sums(left)
    top = max_len
    while True:
        while top and not left[top]:
            top -= 1
        if not top:
            return runs
        pattern, gap = [top], max_len - top
        left[top] -= 1
        while gap:
            if (rest := _exact(left, gap, sums)) is None:
                fits = np.flatnonzero(left[1 : gap + 1])
                if not len(fits):
                    break
                rest = [int(fits[-1]) + 1]
            for n in rest:
                left[n] -= 1
                gap -= n
                pattern.append(n)
        for n in pattern:
            left[n] += 1
        own = np.bincount(pattern, minlength=max_len + 1)
        times = int((left[own > 0] // own[own > 0]).min())
        offset = 0
        for n in pattern:
            runs.append((n, int(used[n]), times, sequence, offset))
            used[n] += times
            left[n] -= times
            offset += n
        sequence += times


def place(pieces: DataFrame, max_len: int = 4096) -> DataFrame:
    """pieces (with length, part and nth, unique within a length) with sequence_id and offset.

    Reads pieces three times, so they should be a written table. Columns named sequence_id,
    offset or before__ are replaced. No rows give no rows.
    """
    spark = pieces.sparkSession
    counts = pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("length", "part", (F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")).alias("before__"))
    histogram = {r.length: r.n for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most max_len rows
    runs = np.array(sorted(pack_plan(histogram, max_len)), dtype=np.int64).reshape(-1, 5)
    plan = spark.sparkContext.broadcast(runs)  # bounded by the distinct lengths
    ranked = pieces.drop("sequence_id", "offset", "before__").join(before, ["length", "part"])
    ranked = ranked.withColumn("rank__", F.col("before__") + F.col("nth")).drop("before__")

    @F.pandas_udf("sequence_id bigint, offset bigint")
    def at(length, rank):  # noqa: ANN001
        import pandas as pd

        forget()
        runs = plan.value
        key = runs[:, 0] << 44 | runs[:, 1]
        i = np.searchsorted(key, length.to_numpy() << 44 | rank.to_numpy(), side="right") - 1
        return pd.DataFrame({"sequence_id": runs[i, 3] + rank.to_numpy() - runs[i, 1], "offset": runs[i, 4]})

    out = ranked.withColumn("at__", at("length", "rank__"))
    return out.withColumns({"sequence_id": F.col("at__.sequence_id"), "offset": F.col("at__.offset")}).drop("at__", "rank__")


def best_fit_pack(docs: DataFrame, file: str, max_len: int = 4096, end_id: int = 1) -> tuple[DataFrame, DataFrame]:
    """(pieces with their ids, placement without ids), joined by (part, length, nth).

    docs needs doc_id and text; other columns, whatever their names, are not read.
    Rows with a null or repeated doc_id are packed like any others.
    """
    spark = docs.sparkSession
    pieces = written(token_pieces(docs, file, max_len, end_id), work_dir(spark), "pieces")
    keyed = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "part", "nth")
    return pieces, place(keyed, max_len)


def packed_digest(docs: DataFrame, file: str, max_len: int = 4096, end_id: int = 1) -> DataFrame:
    _, placed = best_fit_pack(docs, file, max_len, end_id)
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def unpack(spark: SparkSession, pieces: DataFrame, placed: DataFrame) -> DataFrame:
    """(sequence_id, ids binary) of each packed sequence, its pieces in order of offset."""
    joined = pieces.select("part", "length", "nth", "ids").join(placed.select("part", "length", "nth", "sequence_id", "offset"), ["part", "length", "nth"])
    parts = joined.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))  # at most max_len pieces
    return parts.select("sequence_id", F.aggregate("parts", F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x.ids)).alias("ids"))
