"""Removal of repeated byte windows by a depth-limited radix sort of suffixes.

A suffix is followed only to the threshold. Its digits, most significant first, are: the
window's minimizer gram; the whole run of windows that share that minimizer; then, only
where a gram occurs in unequal runs, the core that 32 neighbouring windows have in common,
the union of the 32, and last the single window. Each pass groups by the next digit, drops
what is alone in its group, and settles what is equal as a whole, so long equal stretches
cost a row per 170 bytes or so, and single windows are looked at only beside an edit or the
end of a passage. Suffixes in one final group are exactly the windows that occur twice.

The same passes over words, each written as the four bytes of a hash, report passages of
PASSAGE words, whatever their length in bytes; these are counted, not removed.

Digits are 64-bit polynomial hashes of the bytes. Every pass is a sum by key (combined
before the shuffle) and a join on the keys that remain, so a passage in a third of all
documents costs no task more than its share; the text is read twice, and its rows are
shuffled only if more documents are affected than a broadcast of their keys may name.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from lexmill.llm._common import released, removed, work_dir, written
from lexmill.llm.shingles import _BASE, _BYTE, _INVERSE, grouped, mixed, powers, word_hashes

#: Threshold in bytes, bytes hashed at a time, documents named in a broadcast at most.
WINDOW, GROUP_BYTES, FEW = 400, 1 << 18, 500_000
#: Words of a passage that is reported, bytes of a word's hash.
PASSAGE, WORD_BYTES = 50, 4


def gram_of(window: int) -> int:
    """Bytes of the minimizer gram of a window: 64 of 400."""
    return max(1, window * 4 // 25)


def block_of(window: int) -> int:
    """Windows of a block: 32 of 400 bytes."""
    return max(1, window * 2 // 25)


def symbols(texts: list[str | None], words: bool) -> list[bytes]:
    """Each text's UTF-8 bytes, or its words as WORD_BYTES of their hashes each; null counts as empty."""
    if not words:
        return [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    out = []
    for _, group in grouped(texts):
        hashes, edges = word_hashes(group)
        data = hashes.astype("<u4").tobytes()
        out += [data[WORD_BYTES * a : WORD_BYTES * b] for a, b in zip(edges.tolist(), edges[1:].tolist())]
    return out


def prefix_sums(data: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * powers(_BASE, len(data))[: len(data)], out=sums[1:])
    return sums


def hashed(sums: np.ndarray, lo: np.ndarray, hi: np.ndarray, salt: np.ndarray | int = 0) -> np.ndarray:
    """Hashes of the byte ranges [lo, hi), each with its salt."""
    salt = np.asarray(salt, np.int64).view(np.uint64) if not np.isscalar(salt) else np.uint64(salt)
    return mixed((sums[hi] - sums[lo]) * powers(_INVERSE, len(sums))[lo] + mixed((hi - lo).astype(np.uint64) + (salt << np.uint64(20)), 31), 32)


def runs(pieces: list[bytes], window: int = WINDOW):
    """(prefix sums, piece, start in the buffer, windows, anchor in the buffer, piece starts) of the runs of windows with one minimizer."""
    gram = gram_of(window)
    data = np.frombuffer(b"".join(pieces), np.uint8)
    first = np.cumsum([0, *map(len, pieces)])
    sums = prefix_sums(data)
    none = np.empty(0, np.int64)
    if len(data) < window:
        return sums, none, none, none, none, first
    w = window - gram + 1
    at = np.arange(len(data) - gram + 1)
    key = hashed(sums, at, at + gram) & ~np.uint64(0xFFFFFF) | at.astype(np.uint64)
    rows = np.full(-(-len(key) // w) * w, np.uint64(2**64 - 1))
    rows[: len(key)] = key
    rows = rows.reshape(-1, w)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    count = len(data) - window + 1
    anchor = (np.minimum(behind[:count], ahead[w - 1 : w - 1 + count]) & np.uint64(0xFFFFFF)).astype(np.int64)
    stop = np.zeros(count + 1, np.int64)  # windows that reach into the next piece
    sizes = np.diff(first)
    begin = np.maximum(first[1:] - window + 1, first[:-1])[sizes > 0]
    np.add.at(stop, np.minimum(begin, count), 1)
    np.add.at(stop, np.minimum(first[1:][sizes > 0], count), -1)
    valid = np.flatnonzero(np.cumsum(stop[:-1]) == 0)
    if not len(valid):
        return sums, none, none, none, none, first
    own = anchor[valid]
    edge = np.flatnonzero(np.r_[True, (own[1:] != own[:-1]) | (valid[1:] != valid[:-1] + 1)])
    start = valid[edge]
    return sums, np.searchsorted(first, start, side="right") - 1, start, np.diff(np.append(edge, len(valid))), own[edge], first


def cut(texts: list[bytes], window: int = WINDOW):
    """Lists of (row, offset, bytes) of about GROUP_BYTES: whole texts, or stretches of long ones that share window - 1 bytes."""
    group, size = [], 0
    for row, text in enumerate(texts):
        for at in range(0, max(1, len(text) - window + 1), GROUP_BYTES):
            piece = text[at : at + GROUP_BYTES + window - 1]
            group.append((row, at, piece))
            size += len(piece)
            if size >= GROUP_BYTES:
                yield group
                group, size = [], 0
    if group:
        yield group


def _runs_of(texts: list[bytes], window: int):
    """(row, start in the text, windows, anchor's offset in the run, gram, hull, group's bytes and place) by group."""
    for group in cut(texts, window):
        sums, piece, start, n, anchor, first = runs([p for _, _, p in group], window)
        if len(start):
            row, at = (np.array([g[i] for g in group], np.int64) for i in (0, 1))
            offset = anchor - start
            hull = hashed(sums, start, start + n - 1 + window, offset)
            yield row[piece], at[piece] + start - first[piece], n, offset, hashed(sums, anchor, anchor + gram_of(window), 1).view(np.int64), hull.view(np.int64)


def keyed(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with key__, a hash of the id and the text: equal rows have equal results."""
    return docs.withColumn("key__", F.xxhash64(F.col("doc_id").cast("bigint"), F.col(text).cast("string")))


def run_table(docs: DataFrame, window: int, text: str, words: bool = False) -> DataFrame:
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            key = batch.column(0).to_numpy()
            texts = symbols(batch.column(1).to_pylist(), words)
            for row, start, n, _, gram, hull in _runs_of(texts, window):
                yield pa.RecordBatch.from_arrays([pa.array(key[row]), pa.array(start), pa.array(n.astype(np.int32)), pa.array(gram), pa.array(hull)], names=["key__", "start", "n", "gram", "hull"])

    return docs.select("key__", F.col(text).cast("string")).mapInArrow(run, "key__ bigint, start bigint, n int, gram bigint, hull bigint")


def cell_table(docs: DataFrame, asked: DataFrame, window: int, text: str, words: bool = False) -> DataFrame:
    """(hull, alone, key__, start, n, offset, content) of the asked runs; asked: (key__, want: array of struct(hull, alone))."""

    def run(batches):
        import pyarrow as pa

        types = (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
        for batch in batches:
            key = batch.column(0).to_numpy()
            texts = symbols(batch.column(1).to_pylist(), words)
            wanted = [{w["hull"]: w["alone"] for w in ws} for ws in batch.column(2).to_pylist()]
            rows: tuple[list, ...] = ([], [], [], [], [], [], [])
            for row, start, n, offset, _, hull in _runs_of(texts, window):
                for r, s, m, o, h in zip(row.tolist(), start.tolist(), n.tolist(), offset.tolist(), hull.tolist()):
                    if (alone := wanted[r].pop(h, None)) is not None:
                        for column, value in zip(rows, (h, alone, int(key[r]), s, m, o, texts[r][s : s + m - 1 + window])):
                            column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, types)], names=["hull", "alone", "key__", "start", "n", "offset", "content"])

    whole = docs.select("key__", F.col(text).cast("string").alias("text__"))
    asked = asked.withColumnRenamed("key__", "k2__")
    if asked.count() <= FEW:
        whole = whole.join(F.broadcast(asked.select("k2__")), F.col("key__") == F.col("k2__"), "left_semi")
    return whole.join(asked, F.col("key__") == F.col("k2__")).select("key__", "text__", "want").mapInArrow(run, "hull bigint, alone boolean, key__ bigint, start bigint, n int, offset int, content binary")


def _contents(batch, column: int):
    data = batch.column(column).to_pylist()
    base = np.cumsum([0, *map(len, data)])
    return prefix_sums(np.frombuffer(b"".join(data), np.uint8)), base[:-1]


def block_table(cells: DataFrame, window: int) -> DataFrame:
    """(hull, alone, core, union, lo, hi) of each block of windows lo..hi of each cell."""

    def run(batches):
        import pyarrow as pa

        size = block_of(window)
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                n, o = (batch.column(i).to_numpy().astype(np.int64) for i in (2, 3))
                sums, base = _contents(batch, 4)
                low, high = (o - n + 1) // size, o // size
                many = high - low + 1
                i = np.repeat(np.arange(len(n)), many)
                q = np.arange(len(i)) - np.repeat(np.cumsum(many) - many, many) + low[i]
                lo, hi = o[i] - np.minimum(size * q + size - 1, o[i]), o[i] - np.maximum(size * q, o[i] - n[i] + 1)
                left = base[i] + o[i] - size * q
                core = hashed(sums, left, left - size + 1 + window, 2 + q)
                union = hashed(sums, base[i] + lo, base[i] + hi + window, 1000 + (o[i] - lo))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(i)), batch.column(1).take(pa.array(i)), pa.array(core.view(np.int64)), pa.array(union.view(np.int64)), pa.array(lo.astype(np.int32)), pa.array(hi.astype(np.int32))], names=["hull", "alone", "core", "union", "lo", "hi"])

    return cells.select("hull", "alone", "n", "offset", "content").mapInArrow(run, "hull bigint, alone boolean, core bigint, union bigint, lo int, hi int")


def window_table(blocks: DataFrame, cells: DataFrame, window: int) -> DataFrame:
    """(digit, hull, alone, at) of each window of the blocks."""

    def run(batches):
        import pyarrow as pa

        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                lo, hi, o = (batch.column(i).to_numpy().astype(np.int64) for i in (2, 3, 4))
                sums, base = _contents(batch, 5)
                i = np.repeat(np.arange(len(lo)), hi - lo + 1)
                j = np.arange(len(i)) - np.repeat(np.cumsum(hi - lo + 1) - (hi - lo + 1), hi - lo + 1) + lo[i]
                digit = hashed(sums, base[i] + j, base[i] + j + window, o[i] - j)
                yield pa.RecordBatch.from_arrays([pa.array(digit.view(np.int64)), batch.column(0).take(pa.array(i)), batch.column(1).take(pa.array(i)), pa.array(j.astype(np.int32))], names=["digit", "hull", "alone", "at"])

    joined = blocks.select("hull", "alone", "lo", "hi").join(cells.select("hull", "offset", "content"), "hull").select("hull", "alone", "lo", "hi", "offset", "content")
    return joined.mapInArrow(run, "digit bigint, hull bigint, alone boolean, at int")


def twice(table: DataFrame, key: str) -> DataFrame:
    return table.groupBy(key).agg(F.count(F.lit(1)).alias("k__")).where("k__ > 1").select(key)


def repeated_ranges(docs: DataFrame, window: int = WINDOW, text: str = "text", words: bool = False) -> DataFrame:
    """(key__, lo, hi): byte ranges of the documents, or of the hashes of their words, that repeated windows cover; docs need key__."""
    folder = work_dir(docs.sparkSession)
    table = written(run_table(docs, window, text, words), folder, "runs")
    classes = table.groupBy("gram", "hull").agg(F.count(F.lit(1)).alias("c"), F.min("key__").alias("key__"))
    classes = written(classes, folder, "classes")
    shared = classes.groupBy("gram").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("gram")
    same = classes.where("c > 1").select("gram", "hull")
    ranges = table.join(same, ["gram", "hull"]).select("key__", F.col("start").alias("lo"), (F.col("start") + F.col("n") - 1 + window).alias("hi"))
    asked = classes.join(shared, "gram").groupBy("key__").agg(F.collect_list(F.struct("hull", (F.col("c") == 1).alias("alone"))).alias("want"))
    cells = written(cell_table(docs, written(asked, folder, "asked"), window, text, words), folder, "cells")
    cells = cells.where("content is not null")

    blocks = written(block_table(cells, window), folder, "blocks")
    blocks = written(blocks.join(twice(blocks, "core"), "core"), folder, "cores")
    whole = blocks.join(twice(blocks, "union"), "union").where("alone").select("hull", "lo", "hi")
    open_ = blocks.where("alone").join(twice(blocks, "union"), "union", "left_anti").select("core").distinct()
    windows = written(window_table(blocks.join(open_, "core", "left_semi"), cells, window), folder, "windows")
    single = windows.where("alone").join(twice(windows, "digit"), "digit").select("hull", F.col("at").alias("lo"), F.col("at").alias("hi"))
    place = cells.where("alone").select("hull", "key__", "start")
    found = whole.unionByName(single).join(place, "hull").select("key__", (F.col("start") + F.col("lo")).alias("lo"), (F.col("start") + F.col("hi") + window).alias("hi"))
    found = written(ranges.unionByName(found), folder, "ranges")
    for name in ("runs", "classes", "asked", "cells", "blocks", "cores", "windows"):
        removed(docs.sparkSession, f"{folder}/{name}")
    return found


def span_table(docs: DataFrame, window: int = WINDOW, text: str = "text", words: bool = False) -> DataFrame:
    """(k2__, spans): the disjoint ranges of each document that has any, in order; of bytes, or of words. docs need key__."""
    ranges = repeated_ranges(docs, window * WORD_BYTES if words else window, text, words)
    if words:  # a window between two words says nothing about these
        ranges = ranges.select("key__", F.ceil(F.col("lo") / WORD_BYTES).alias("lo"), F.floor(F.col("hi") / WORD_BYTES).alias("hi"))
    by = Window.partitionBy("key__").orderBy("lo")
    before = F.max("hi").over(by.rowsBetween(Window.unboundedPreceding, -1))
    rows = ranges.withColumn("new", F.coalesce((F.col("lo") > before).cast("int"), F.lit(1)))
    rows = rows.withColumn("island", F.sum("new").over(by.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    rows = rows.groupBy("key__", "island").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    rows = rows.groupBy(F.col("key__").alias("k2__")).agg(F.sort_array(F.collect_list(F.struct("lo", "hi"))).alias("spans"))
    out = written(rows, work_dir(docs.sparkSession), "spans")
    released(docs.sparkSession)
    return out


def with_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """docs with the columns of spans for their keys, empty where there are none; texts are shuffled only if more documents have some than a broadcast may name."""
    names = [c for c in spans.columns if c != "k2__"]
    none = {c: F.expr("cast(array() as array<struct<lo: bigint, hi: bigint>>)") for c in names}
    if spans.count() > FEW:
        return docs.join(spans, F.col("key__") == F.col("k2__"), "left").drop("k2__").withColumns({c: F.coalesce(c, none[c]) for c in names})
    named = F.broadcast(spans.select("k2__"))
    some = docs.join(named, F.col("key__") == F.col("k2__"), "left_semi").join(spans, F.col("key__") == F.col("k2__")).drop("k2__")
    return docs.join(named, F.col("key__") == F.col("k2__"), "left_anti").withColumns(none).unionByName(some)


@F.pandas_udf(BinaryType())
def _without(data: pd.Series, lo: pd.Series, hi: pd.Series) -> pd.Series:
    def cut(text, lo, hi):  # noqa: ANN001
        edges = np.r_[0, np.stack([lo, hi], 1).ravel(), len(text)].tolist()
        return b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))

    return pd.Series([cut(bytes(t), a, b) for t, a, b in zip(data, lo, hi)], dtype=object)


def without_repeats(docs: DataFrame, window: int = WINDOW, text: str = "text", passage: int = 0) -> DataFrame:
    """docs with n_bytes, spans (removed byte ranges, disjoint, in order) and kept (the bytes left).

    Removes every byte covered by a string of `window` bytes that also starts anywhere else;
    null texts count as empty, which have no spans; texts of any length are hashed in stretches
    of GROUP_BYTES; rows that are equal as a whole count as occurrences of their own, and ties
    do not arise, for all occurrences go. With passage, also passages: the ranges of words that
    strings of so many words cover that occur elsewhere too. Columns of the names added are replaced.
    """
    docs = keyed(docs.drop("n_bytes", "spans", "kept", "key__", "k2__", *["passages"][: bool(passage)]), text)
    spans = span_table(docs, window, text)
    if passage:
        none = F.expr("cast(array() as array<struct<lo: bigint, hi: bigint>>)")
        passages = span_table(docs, passage, text, True).select("k2__", F.col("spans").alias("passages"))
        spans = spans.join(passages, "k2__", "full").select("k2__", *[F.coalesce(c, none).alias(c) for c in ("spans", "passages")])
        spans = written(spans, work_dir(docs.sparkSession), "both")
    rows = with_spans(docs, spans)
    rows = rows.withColumn("data__", F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")).withColumn("n_bytes", F.octet_length("data__").cast("bigint"))
    left = _without("data__", F.col("spans.lo"), F.col("spans.hi"))
    return rows.withColumn("kept", F.when(F.size("spans") > 0, left).otherwise(F.col("data__"))).drop("data__", "key__")


def covered(spans: str) -> Column:
    return F.aggregate(spans, F.lit(0).cast("bigint"), lambda a, s: a + s["hi"] - s["lo"])


def window_digest(docs: DataFrame) -> DataFrame:
    """The columns asked for, and n_passage_words: the words of passages of at least PASSAGE words that occur elsewhere too."""
    rows = without_repeats(docs.select("doc_id", "text"), passage=PASSAGE)
    return rows.select("doc_id", "n_bytes", covered("spans").alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"), covered("passages").alias("n_passage_words"))
