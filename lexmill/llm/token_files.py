"""Token ids as files: canonical length-limited Huffman codes in independent blocks.

A table of segments in Parquet (written uncompressed: the payload has no redundancy left) is
the file format, so that any store that Spark writes to can hold it. Layout of a segment:

* part, segment: place in ascending doc_id order; start: ids before it within its part;
* doc_ids, counts: 64-bit ids and id counts of its documents, little-endian;
* blocks: for each block of at most BLOCK ids of one document, the bit offset of its first
  code in the payload (the checkpoint) and its id count, as 64-bit and 32-bit integers;
* payload: codes, most significant bit first; each document starts at a whole byte.

The code book (id, code length) is a table beside it: canonical codes follow from lengths.
Blocks decode independently, all of a segment's in step, by one table look-up per id.
"""

from __future__ import annotations


import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm._common import work_dir, written
from lexmill.llm.tokens import encoder, forget

#: A segment ends when its ids and ROW for each of its documents come to SEGMENT_IDS.
MAX_BITS, BLOCK, SEGMENT_IDS, ROW = 18, 512, 1 << 20, 16


def limited_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most max_bits for positive counts, by package-merge."""
    n = len(counts)
    if n <= 1:
        return np.ones(n, np.int64)
    if n > 1 << max_bits:
        raise ValueError(f"{n} symbols need more than {max_bits} bits")
    order = np.argsort(counts, kind="stable")
    leaves = counts[order].astype(np.float64)
    levels, packages = [], np.empty(0)
    for _ in range(max_bits):
        both = np.concatenate([leaves, packages])
        rank = np.argsort(both, kind="stable")
        levels.append(rank < n)
        merged = both[rank]
        merged = merged[: len(merged) // 2 * 2]
        packages = merged[::2] + merged[1::2]
    lengths, take = np.zeros(n, np.int64), 2 * n - 2
    for leaf in reversed(levels):
        own = int(leaf[:take].sum())
        lengths[:own] += 1
        take = 2 * (take - own)
    out = np.empty(n, np.int64)
    out[order] = lengths
    return out


def code_book(symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(codes, lengths) by id: canonical, shorter first, then by id."""
    size = int(symbols.max()) + 1 if len(symbols) else 1
    codes, by_id = np.zeros(size, np.uint64), np.zeros(size, np.int64)
    code = last = 0
    for i in np.lexsort((symbols, lengths)):
        code <<= int(lengths[i]) - last
        last = int(lengths[i])
        codes[symbols[i]], by_id[symbols[i]] = code, last
        code += 1
    return codes, by_id


def decode_table(codes: np.ndarray, lengths: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """For each value of the next max_bits bits, the id in the high bits and the code's length in the low five."""
    table = np.zeros(1 << max_bits, np.uint32)
    used = np.flatnonzero(lengths)
    used = used[np.argsort(codes[used] << (max_bits - lengths[used]).astype(np.uint64))]
    spans = 1 << (max_bits - lengths[used])
    table[: spans.sum()] = np.repeat(used << 5 | lengths[used], spans)
    return table


def packed_bits(codes: np.ndarray, lengths: np.ndarray, at: np.ndarray, n_bytes: int) -> bytes:
    """The codes written at the given ascending bit offsets."""
    words = np.zeros(n_bytes // 8 + 2, np.uint64)
    if len(codes):
        word, into = at >> 6, at & 63
        left = codes << (64 - lengths).view(np.uint64)
        first = np.flatnonzero(np.diff(word, prepend=-1))
        words[word[first]] = np.add.reduceat(left >> into.view(np.uint64), first)
        over = np.flatnonzero(into + lengths > 64)
        words[word[over] + 1] |= left[over] << (64 - into[over]).view(np.uint64)
    return words.byteswap().tobytes()[:n_bytes]


def encoded(ids: list[np.ndarray], codes: np.ndarray, lengths: np.ndarray) -> list[tuple[bytes, np.ndarray]]:
    """Each document's payload, from a whole byte on, and the bit offsets of its blocks."""
    every = np.concatenate(ids) if ids else np.empty(0, np.uint32)
    entry = (codes << np.uint64(5) | lengths.astype(np.uint64))[every]
    size = (entry & np.uint64(31)).astype(np.int64)
    ends = np.cumsum(size)
    edge = np.cumsum([0, *map(len, ids)])
    before = np.concatenate([[0], ends])[edge]
    whole = (np.diff(before) + 7) // 8
    byte = np.concatenate([[0], np.cumsum(whole)])
    at = ends - size + np.repeat(byte[:-1] * 8 - before[:-1], np.diff(edge))
    data = packed_bits(entry >> np.uint64(5), size, at, int(byte[-1]))
    return [(data[byte[i] : byte[i + 1]], (at[edge[i] : edge[i + 1] : BLOCK] - 8 * byte[i])) for i in range(len(ids))]


def decoded(payload: bytes, offsets: np.ndarray, counts: np.ndarray, table: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """The ids of all blocks, one after another; every step decodes one id of each block left.

    Blocks go in groups whose longest is less than twice as long as the others, so what is
    held follows the ids, not the longest block times the blocks.
    """
    words = np.frombuffer(payload + b"\0" * (16 - len(payload) % 8), ">u4").astype(np.uint64)
    pairs = words[:-1] << np.uint64(32) | words[1:]
    order = np.argsort(-counts, kind="stable")
    offset, left = offsets[order].astype(np.int64), counts[order]
    first = (np.cumsum(counts) - counts)[order]
    out = np.empty(int(counts.sum()), np.uint32)
    mask = np.uint64((1 << max_bits) - 1)
    lo = 0
    while lo < len(left) and left[lo]:
        steps = int(left[lo])
        hi = int(np.searchsorted(-left, -(steps // 2), side="left"))
        at, n, place = offset[lo:hi], left[lo:hi], first[lo:hi]
        for step, active in enumerate(np.searchsorted(-n, -np.arange(steps), side="left")):
            p = at[:active]
            row = table[pairs[p >> 5] >> (64 - max_bits - (p & 31)).view(np.uint64) & mask]
            p += row & 31
            out[place[:active] + step] = row >> 5
        lo = hi
    return out


def id_table(docs: DataFrame, file: str, end_id: int = 0) -> DataFrame:
    """(doc_id, ids binary, width, id, n): a row a document, ids of the whole text and the end id, unsigned of width bytes
    (2 if the vocabulary allows it, else 4); and, with width 0, how often each task met each id."""

    def run(batches):
        import pyarrow as pa

        encode = encoder(file)
        width = 4 if encode.tokenizer.get_vocab_size() > 1 << 16 else 2
        end = np.array([end_id], "<u4").tobytes()
        names = ["doc_id", "ids", "width", "id", "n"]
        total = np.zeros(0, np.int64)
        for batch in batches:
            doc_ids, texts = batch.column(0), batch.column(1)
            for lo in range(0, batch.num_rows, 2000):
                ids = [x + end for x in encode(texts[lo : lo + 2000].to_pylist())]
                flat = np.frombuffer(b"".join(ids), "<u4").astype(f"<u{width}")
                got = np.bincount(flat, minlength=len(total))
                got[: len(total)] += total
                total, data = got, flat.tobytes()
                edge = (np.cumsum([0, *map(len, ids)]) // (4 // width)).tolist()
                ids = [data[x:y] for x, y in zip(edge, edge[1:])]
                yield pa.RecordBatch.from_arrays([doc_ids[lo : lo + 2000], pa.array(ids, pa.binary()), pa.array([width] * len(ids), pa.int32()), pa.nulls(len(ids), pa.int64()), pa.nulls(len(ids), pa.int64())], names=names)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.nulls(len(met), pa.int64()), pa.nulls(len(met), pa.binary()), pa.array([0] * len(met), pa.int32()), pa.array(met, pa.int64()), pa.array(total[met], pa.int64())], names=names)

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, "doc_id bigint, ids binary, width int, id bigint, n bigint")


SEGMENT = "part int, segment int, start bigint, n_ids bigint, doc_ids binary, known binary, counts binary, block_at binary, block_n binary, payload binary"


def write_ids(docs: DataFrame, file: str, end_id: int = 0, folder: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Write the ids of all documents in ascending doc_id order; (segments, code book) read back.

    Null texts count as empty, null doc_ids come first, equal doc_ids keep all their rows, in
    any order among themselves. A very long text is many blocks of one segment. An empty table
    gives no segments.
    """
    spark = docs.sparkSession
    folder = folder or work_dir(spark)
    table = written(id_table(docs, file, end_id), folder, "ids")
    counted = table.where("width = 0").groupBy("id").agg(F.sum("n").alias("n")).toPandas()  # at most one row per id of the vocabulary
    table = table.where("width > 0").select("doc_id", "ids", "width")
    symbols = counted["id"].to_numpy(np.int64)
    book = spark.createDataFrame([(int(s), int(n)) for s, n in zip(symbols, limited_lengths(counted["n"].to_numpy()))], "id int, bits int")
    book = written(book.coalesce(1), folder, "book")
    shared = spark.sparkContext.broadcast(read_book(book))

    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    share = [i / parts for i in range(1, parts)] or [0.5]
    known = table.agg(F.percentile_approx("doc_id", share, 10000).alias("b"), F.count(F.lit(1)).alias("n"), F.count("doc_id").alias("k")).first()
    bounds = spark.sparkContext.broadcast(np.array(sorted(set(known.b or [])), np.int64))  # one bound a partition
    nameless = min(parts, known.n - known.k) or 1  # parts among which rows without an id are dealt, before all others

    def code(batches):
        import pyarrow as pa

        forget()
        codes, lengths = shared.value
        turn = 0
        for batch in batches:
            for lo in range(0, batch.num_rows, 100):
                own = batch.slice(lo, 100)
                ids = [np.frombuffer(x, f"<u{w}") for x, w in zip(own.column(1).to_pylist(), own.column(2).to_pylist())]
                got = encoded(ids, codes, lengths)
                doc_id = own.column(0)
                part = np.searchsorted(bounds.value, doc_id.fill_null(0).to_numpy(), side="left") + nameless
                none = np.flatnonzero(np.asarray(doc_id.is_null()))
                part[none] = (turn + np.arange(len(none))) % nameless
                turn += len(none)
                yield pa.RecordBatch.from_arrays([doc_id, pa.array([len(x) for x in ids], pa.int64()), pa.array([x.astype("<i8").tobytes() for _, x in got], pa.binary()), pa.array([x for x, _ in got], pa.binary()), pa.array(part, pa.int32())], names=["doc_id", "n", "at", "payload", "part"])

    coded = table.mapInArrow(code, "doc_id bigint, n bigint, at binary, payload binary, part int")
    coded = coded.repartitionById(len(bounds.value) + 1 + nameless, "part").sortWithinPartitions("part", "doc_id")

    def segments(batches):
        import pyarrow as pa

        part, segment, start, held = None, 0, 0, []

        def flush():
            nonlocal segment, start, held
            doc_ids, n, at, payload = zip(*held)
            byte = np.cumsum([0, *map(len, payload)])
            n = np.array(n, np.int64)
            block_at = np.concatenate([np.frombuffer(x, "<i8") + 8 * b for x, b in zip(at, byte)])
            many = -(-n // BLOCK)
            block_n = np.full(int(many.sum()), BLOCK, np.int64)
            block_n[np.cumsum(many) - 1] = n - BLOCK * (many - 1)
            columns = (part, segment, start, int(n.sum()), np.array([x or 0 for x in doc_ids], "<i8").tobytes(), bytes(x is not None for x in doc_ids), n.astype("<i8").tobytes(), block_at.astype("<i8").tobytes(), block_n.astype("<i4").tobytes(), b"".join(payload))
            types = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), *[pa.binary()] * 6)
            batch = pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(columns, types)], names=[x.split()[0] for x in SEGMENT.split(", ")])
            segment, start, held = segment + 1, start + int(n.sum()), []
            return batch

        size = 0
        for batch in batches:
            for doc_id, n, at, payload, own in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if held and (own != part or size >= SEGMENT_IDS):
                    yield flush()
                    size = 0
                if own != part:
                    part, segment, start = own, 0, 0
                held.append((doc_id, n, at, payload))
                size += n + ROW
        if held:
            yield flush()

    return written(coded.mapInArrow(segments, SEGMENT), folder, "segments", "uncompressed"), book


def read_book(book: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    rows = book.toPandas()
    return code_book(rows["id"].to_numpy(np.int64), rows["bits"].to_numpy(np.int64))


def read_ids(segments: DataFrame, book: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids binary of unsigned 32-bit integers) of every document in the files."""
    spark = segments.sparkSession
    sums = segments.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()  # one row a partition that was written
    first, total = {}, 0
    for r in sorted(sums, key=lambda r: r.part):
        first[r.part], total = total, total + r.n
    shared, first = spark.sparkContext.broadcast(read_book(book)), spark.sparkContext.broadcast(first)

    def run(batches):
        import pyarrow as pa

        forget()
        table = decode_table(*shared.value)
        for batch in batches:
            for row in batch.to_pylist():
                n = np.frombuffer(row["counts"], "<i8")
                got = decoded(row["payload"], np.frombuffer(row["block_at"], "<i8"), np.frombuffer(row["block_n"], "<i4").astype(np.int64), table).astype("<u4")
                start = np.cumsum(n) - n
                doc_ids = np.frombuffer(row["doc_ids"], "<i8")
                known = np.frombuffer(row["known"], np.uint8) == 0
                data = got.tobytes()
                yield pa.RecordBatch.from_arrays([pa.array(doc_ids, mask=known), pa.array(start + row["start"] + first.value[row["part"]]), pa.array(n), pa.array([data[4 * a : 4 * (a + b)] for a, b in zip(start.tolist(), n.tolist())], pa.binary())], names=["doc_id", "start", "n_tokens", "ids"])

    return segments.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids binary")


def ids_digest(docs: DataFrame, file: str, end_id: int = 0) -> DataFrame:
    segments, book = write_ids(docs, file, end_id)
    return read_ids(segments, book).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


__all__ = ["ids_digest", "read_ids", "write_ids"]
