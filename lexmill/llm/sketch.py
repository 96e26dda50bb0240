"""A bounded sketch of how often hashed tokens occur: counters summed over tasks, sent in chunks."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

#: Counters of the sketch and the rows it is sent in.
COUNTERS, CHUNKS = 1 << 18, 64


def counted(slots: np.ndarray) -> np.ndarray:
    """How often each counter is meant; slots are hashes, of which the low bits count."""
    return np.bincount((slots & np.uint64(COUNTERS - 1)).astype(np.int64), minlength=COUNTERS)


def chunks(sketch: np.ndarray) -> list[bytes]:
    return [x.tobytes() for x in np.minimum(sketch, 2**31 - 1).astype("<i4").reshape(CHUNKS, -1)]


def crowding(rows: DataFrame) -> np.ndarray:
    """rows (chunk, counters): for each counter, twice the logarithm of its ratio to the mean, 0 for most and 15 at most."""

    def add(batches):
        import pyarrow as pa

        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                total[chunk] = total.get(chunk, 0) + np.frombuffer(data, "<i4").astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array([x.astype("<i8").tobytes() for x in total.values()], pa.binary())], names=["chunk", "counters"])

    sums = rows.select("chunk", "counters").repartition(CHUNKS, "chunk").mapInArrow(add, "chunk bigint, counters binary").collect()  # COUNTERS numbers
    sketch = np.zeros((CHUNKS, COUNTERS // CHUNKS))
    for r in sums:
        sketch[r.chunk] += np.frombuffer(r.counters, "<i8")
    return np.clip(2 * np.log2((sketch + 1) / (sketch.mean() + 1)), 0, 15).astype(np.uint8).ravel()
