"""N-gram Jaccard join by prefixes under several global orders.

Two sets with Jaccard similarity t share, under any one order of all tokens, k tokens among
the first n - ceil(t n) + k of each. The first order puts tokens of crowded counters of a
bounded sketch last; a document whose prefix has fewer than k tokens that any other has is
out. The tokens left are counted exactly, and under the order by that count linked documents
share a token of the first s - k + 1 of the s that each has left. Only documents that share
such a token, directly or through others, are in one family, so a common line or passage
makes no family. A third order, by hash, is the last filter before whole sets are compared.

Documents of equal sets are one class. A family's sets are shipped once, in blocks of bounded
size; pairs are counted inside a block and only a spanning forest of the links leaves it.
Large families have anchors in every block; after that only members outside the family's main
component visit the other blocks. The more documents, the more of them are chained by tokens
that a few share by chance, and to hold a chain against itself costs the square of its size.
The members of a family beyond one block therefore meet by token where a token has up to HOT
classes (candidates.py; counters of the sets rule pairs out, then whole sets are compared), and
only its tokens of more classes make families, smaller ones, that are compared in blocks. No
link between different sets is lost, and no family is ever gathered in one place.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexmill.llm._common import work_dir, written
from lexmill.llm.candidates import linked_components
from lexmill.llm.components import connected_components
from lexmill.llm.sketch import CHUNKS, COUNTERS, chunks, counted, crowding
from lexmill.llm.shingles import grouped, mixed, set_id, shingle_sets

#: Documents named in a broadcast at most.
FEW = 500_000
#: Prefixes are longer by this percentage of the set, and linked sets then share as many tokens more.
MORE = 10
#: Tokens and classes of a block, and visitors compared with it at a time.
BLOCK_TOKENS, BLOCK_SETS, VISITORS = 400_000, 800, 200
#: Classes of a token up to which a large family's members meet by token, and counters of 8 bits, in longs, that rule pairs out then.
HOT, COUNTS = 64, 64
BAGS = tuple(f"b{i}" for i in range(COUNTS // 8))


def least_shared(n: int) -> int:
    return max(1, MORE * n // 100)


def prefix_length(n: int, percent: int, shared: int = 1) -> int:
    """The shortest prefix, under any order, of which linked sets share so many tokens."""
    return min(n, n - (percent * n + 99) // 100 + shared)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def named_sets(docs: DataFrame, words: int, text: str = "text") -> DataFrame:
    """kind 0: (doc_id, n, cls) of each document, cls null for empty sets; kind 1: the sketch's counters, by chunk."""

    def run(batches):
        import pyarrow as pa

        sketch = np.zeros(COUNTERS, np.int64)
        types = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
        names = ["kind", "doc_id", "n", "cls", "counters"]
        for batch in batches:
            n, cls = [], []
            for _, group in grouped(batch.column(1).to_pylist()):
                sets = shingle_sets(group, words)
                n += [len(s) for s in sets]
                cls += [set_id(s) if len(s) else None for s in sets]
                sketch += counted(np.concatenate(sets))
            columns = ([0] * len(n), batch.column(0), n, cls, [None] * len(n))
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, types)], names=names)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(([1] * CHUNKS, range(CHUNKS), [0] * CHUNKS, [None] * CHUNKS, chunks(sketch)), types)], names=names)

    return docs.select(F.col("doc_id").cast("bigint"), F.col(text).cast("string")).mapInArrow(run, "kind int, doc_id bigint, n bigint, cls bigint, counters binary")


def prefixes(docs: DataFrame, order, words: int, percent: int, text: str = "text") -> DataFrame:
    """(token, cls, n) of the prefix of each document's set under the first order; repeats of a set within a task are left out."""

    def run(batches):
        import pyarrow as pa

        crowd, seen = order.value, set()
        for batch in batches:
            for _, group in grouped(batch.column(0).to_pylist()):
                tokens, cls, sizes, lengths = [], [], [], []
                for s in shingle_sets(group, words):
                    if not len(s) or (name := set_id(s)) in seen:
                        continue
                    seen.add(name)
                    p = prefix_length(len(s), percent, least_shared(len(s)))
                    key = crowd[(s & np.uint64(COUNTERS - 1)).astype(np.int64)].astype(np.uint64) << np.uint64(60) | mixed(s, 11) >> np.uint64(4)
                    tokens.append(s[np.argpartition(key, p - 1)[:p]])
                    cls.append(name)
                    sizes.append(len(s))
                    lengths.append(p)
                if cls:
                    yield pa.RecordBatch.from_arrays([pa.array(_signed(np.concatenate(tokens))), pa.array(np.repeat(np.array(cls, np.int64), lengths)), pa.array(np.repeat(np.array(sizes, np.int32), lengths))], names=["token", "cls", "n"])

    return docs.select(F.col(text).cast("string")).mapInArrow(run, "token bigint, cls bigint, n int")


def shared_tokens(postings: DataFrame) -> DataFrame:
    """The distinct postings of tokens that two classes or more have; a pass over sorted partitions that holds one row."""

    def run(batches):
        import pyarrow as pa

        held, out = None, False  # the last row, and whether it has been sent
        for batch in batches:
            if not batch.num_rows:
                continue
            token, cls, n = (batch.column(i).to_numpy() for i in range(3))
            if held is not None:
                token, cls, n = (np.concatenate([[h], x]).astype(x.dtype) for h, x in zip(held, (token, cls, n)))
            new = np.ones(len(token), bool)
            new[1:] = (token[1:] != token[:-1]) | (cls[1:] != cls[:-1])
            token, cls, n = token[new], cls[new], n[new]
            same = token[1:] == token[:-1]
            keep = np.append(False, same) | np.append(same, False)
            if held is not None and out:
                keep[0] = False
            out = bool(keep[-1]) or (len(token) == 1 and out)
            held = (token[-1], cls[-1], n[-1])
            yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (token, cls, n)], names=["token", "cls", "n"])

    return postings.repartition("token").sortWithinPartitions("token", "cls").mapInArrow(run, postings.schema)


def second_prefixes(shared: DataFrame, folder: str) -> DataFrame:
    """(token, cls): of each class with enough shared tokens, the prefix by the tokens' exact counts."""
    least = F.greatest(F.lit(1), F.floor(MORE * F.col("n") / 100))
    enough = shared.groupBy("cls").agg(F.count(F.lit(1)).alias("s"), F.min("n").alias("n")).where(F.col("s") >= least)
    likely = written(shared.select("token", "cls").join(enough.select("cls", (F.col("s") - least + 1).alias("p")), "cls"), folder, "likely")
    counts = likely.groupBy("token").agg(F.count(F.lit(1)).alias("k")).where("k > 1")
    rank = F.row_number().over(Window.partitionBy("cls").orderBy("k", "token"))
    alone = likely.join(counts, "token", "left").withColumn("k", F.coalesce("k", F.lit(1).cast("bigint")))
    return alone.withColumn("r", rank).where("r <= p and k > 1").select("token", "cls")


def families(prefix: DataFrame, folder: str) -> DataFrame:
    """(cls, family) of classes that share a token, directly or through others."""
    least = prefix.groupBy("token").agg(F.min("cls").alias("b"))
    edges = prefix.join(least, "token").where("cls <> b").select(F.col("cls").alias("a"), "b").distinct()
    return connected_components(edges, folder, "families").select(F.col("node").alias("cls"), F.col("component").alias("family"))


def whole_sets(docs: DataFrame, wanted: DataFrame, words: int, text: str = "text") -> DataFrame:
    """(cls, family, tokens) of the wanted classes (doc_id, cls, family)."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            wanted_cls, family = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for first, group in grouped(batch.column(2).to_pylist()):
                rows = [(c, f, s.tobytes()) for c, f, s in zip(wanted_cls[first:], family[first:], shingle_sets(group, words)) if len(s) and set_id(s) == c]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.binary()))], names=["cls", "family", "tokens"])

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text__"))
    joined = texts.join(F.broadcast(wanted) if wanted.count() <= FEW else wanted, "doc_id").select("cls", "family", "text__")
    return joined.mapInArrow(run, "cls bigint, family bigint, tokens binary")


def pair_counts(sets: list[np.ndarray]) -> np.ndarray:
    """How many tokens each two sets share, above the diagonal."""
    d = len(sets)
    flat, own = np.concatenate(sets), np.repeat(np.arange(d), [len(s) for s in sets])
    order = np.argsort(flat, kind="stable")
    flat, own = flat[order], own[order]
    edge = np.flatnonzero(np.r_[True, flat[1:] != flat[:-1], True])
    length = np.diff(edge)
    out = np.zeros(d * d, np.int64)
    for n in np.unique(length[length > 1]):
        start = edge[:-1][length == n]
        x, y = np.triu_indices(n, 1)
        step = max(1, 500_000 // len(x))
        for lo in range(0, len(start), step):
            m = own[start[lo : lo + step, None] + np.arange(n)]
            out += np.bincount((m[:, x] * d + m[:, y]).ravel(), minlength=d * d)
    return out.reshape(d, d)


def similar_pairs(sets: list[np.ndarray], percent: int, first: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Pairs i < j of sets that are similar; with first, only those with i < first <= j."""
    n = np.array([len(s) for s in sets])
    third = [s[np.argpartition(mixed(s, 22), p - 1)[:p]] for s in sets for p in (prefix_length(len(s), percent),)]
    maybe = (pair_counts(third) > 0) & (100 * np.minimum(n[:, None], n) >= percent * np.maximum(n[:, None], n))
    if first:
        maybe[first:], maybe[:, :first] = False, False
    some = np.flatnonzero(maybe.any(axis=0) | maybe.any(axis=1))
    if not len(some):
        return some, some
    common = pair_counts([sets[i] for i in some])
    i, j = np.nonzero((100 * common >= percent * (n[some][:, None] + n[some] - common)) & maybe[np.ix_(some, some)])
    return some[i], some[j]


def _groups(batches, count: int):
    """(key, [(cls, comp, resident, set), …]) of consecutive rows with one key; visitors come VISITORS at a time after the residents."""
    key, rows = None, []
    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(count)]
        for family, block, resident, cls, comp, tokens in zip(*columns):
            if key != (family, block):
                if rows:
                    yield key, rows
                key, rows = (family, block), []
            rows.append((cls, comp, resident, np.frombuffer(tokens, np.uint64)))
            if not resident and sum(not r[2] for r in rows) >= VISITORS:
                yield key, rows
                rows = [r for r in rows if r[2]]
    if rows and (len(rows) > 1):
        yield key, rows


def linked(placed: DataFrame, percent: int) -> DataFrame:
    """(a, b): a forest of the links inside each block, or one link of each visitor to each component of the residents.

    placed: (family, block, resident, cls, comp, tokens); comp is null in the first round, in
    which everything in a block is compared with everything.
    """

    def run(batches):
        import pyarrow as pa

        for _, rows in _groups(batches, 6):
            residents, visitors = [r for r in rows if r[2]], [r for r in rows if not r[2]]
            final = bool(rows) and rows[0][1] is not None
            if len(rows) < 2 or (final and not (residents and visitors)):
                continue
            own = residents + visitors
            i, j = similar_pairs([r[3] for r in own], percent, len(residents) if final else 0)
            a, b, top = [], [], {}

            def root(x):
                while top.get(x, x) != x:
                    x = top[x]
                return x

            seen = set()
            for x, y in zip(i.tolist(), j.tolist()):
                if final:
                    if own[x][1] == own[y][1] or (own[x][1], y) in seen:
                        continue
                    seen.add((own[x][1], y))
                else:
                    s, t = root(x), root(y)
                    if s == t:
                        continue
                    top[max(s, t)] = min(s, t)
                a.append(own[x][0])
                b.append(own[y][0])
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return placed.repartition("family", "block").sortWithinPartitions("family", "block", F.desc("resident")).mapInArrow(run, "a bigint, b bigint")


def block_counts(sets: DataFrame) -> DataFrame:
    """(family, blocks, low, high): the blocks that a family takes, and its smallest and largest class."""
    size = F.octet_length("tokens") / 8
    return sets.groupBy("family").agg(F.ceil(F.greatest(F.sum(size) / BLOCK_TOKENS, F.count(F.lit(1)) / BLOCK_SETS)).cast("int").alias("blocks"), F.min("cls").alias("low"), F.max("cls").alias("high"))


def block_components(sets: DataFrame, percent: int, folder: str) -> DataFrame:
    """(cls, comp) of the classes that have a link to one of their family; sets: (cls, family, tokens)."""
    blocks = written(block_counts(sets), folder, "blocks")
    homed = sets.join(blocks, "family").withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
    none = F.lit(None).cast("bigint")
    own = homed.select("family", "block", F.lit(True).alias("resident"), "cls", none.alias("comp"), "tokens")
    anchors = homed.where("blocks > 1 and (cls = low or cls = high)").withColumn("b", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).where("b <> block")
    anchors = anchors.select("family", F.col("b").alias("block"), F.lit(True).alias("resident"), "cls", none.alias("comp"), "tokens")
    edges = written(linked(own.unionByName(anchors), percent), folder, "links-1")
    labels = connected_components(edges, folder, "cc-1").select(F.col("node").alias("cls"), F.col("component").alias("comp"))
    if blocks.where("blocks > 1").isEmpty():
        return labels

    large = homed.where("blocks > 1").join(labels, "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
    main = large.groupBy("family", "comp").agg(F.count(F.lit(1)).alias("k")).groupBy("family").agg(F.max(F.struct("k", "comp")).alias("m"), F.count(F.lit(1)).alias("comps")).where("comps > 1")
    mixed_ = large.join(main.select("family", F.col("m.comp").alias("main")), "family")
    residents = mixed_.select("family", "block", F.lit(True).alias("resident"), "cls", "comp", "tokens")
    visitors = mixed_.where("comp <> main").withColumn("b", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).where("b <> block")
    visitors = visitors.select("family", F.col("b").alias("block"), F.lit(False).alias("resident"), "cls", "comp", "tokens")
    more = written(linked(residents.unionByName(visitors), percent), folder, "links-2")
    if more.isEmpty():
        return labels
    return connected_components(edges.unionByName(more), folder, "cc-2").select(F.col("node").alias("cls"), F.col("component").alias("comp"))


def set_counts(sets: DataFrame) -> DataFrame:
    """(cls, n, bags): the size of each set, and how many of its tokens fall on each counter, modulo 256."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            if not batch.num_rows:
                continue
            each = [np.frombuffer(t, np.uint64) for t in batch.column(1).to_pylist()]
            n = np.array([len(s) for s in each], np.int32)
            slot = (mixed(np.concatenate(each), 33) % np.uint64(COUNTS)).astype(np.int64) + np.repeat(np.arange(len(each)) * COUNTS, n)
            bags = (np.bincount(slot, minlength=len(each) * COUNTS) & 255).astype(np.uint8).reshape(-1, COUNTS).view("<i8")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), *(pa.array(np.ascontiguousarray(bags[:, k])) for k in range(len(BAGS)))], names=["cls", "n", *BAGS])

    return sets.select("cls", "tokens").mapInArrow(run, "cls bigint, n int, " + ", ".join(f"{b} bigint" for b in BAGS))


def alike(pairs: DataFrame, percent: int) -> DataFrame:
    """(x_cls, y_cls) of the pairs of rows x_… and y_… that sizes and counters leave a chance.

    Of similar sets of n and m tokens at most (n + m) (1 - t) / (1 + t) tokens are of one of them
    alone, and each of these moves one counter by one; counters modulo 256 can only hide that.
    """

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            x, y = (np.stack([batch.column(k).to_numpy() for k in range(lo, lo + len(BAGS))], axis=1).view(np.int8) for lo in (3, 3 + len(BAGS)))
            apart = np.abs((x - y).astype(np.int16)).sum(axis=1)
            keep = pa.array((100 + percent) * apart <= (100 - percent) * batch.column(2).to_numpy())
            yield pa.RecordBatch.from_arrays([batch.column(k).filter(keep) for k in (0, 1)], names=["x_cls", "y_cls"])

    near = pairs.where(100 * F.least("x_n", "y_n") >= percent * F.greatest("x_n", "y_n"))
    return near.select("x_cls", "y_cls", (F.col("x_n") + F.col("y_n")).alias("n"), *[f"{s}_{b}" for s in "xy" for b in BAGS]).mapInArrow(run, "x_cls bigint, y_cls bigint")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes whose sets are similar."""

    def run(batches):
        import pyarrow as pa

        for batch in (b.slice(lo, VISITORS) for b in batches for lo in range(0, b.num_rows, VISITORS)):
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(s.as_buffer(), np.uint64) for s in (x, y))
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([batch.column(k).filter(pa.array(keep, pa.bool_())) for k in (0, 1)], names=["a", "b"])

    sided = lambda s: sets.select(F.col("cls").alias(s), F.col("tokens").alias(f"{s}_tokens"))
    return pairs.join(sided("a"), "a").join(sided("b"), "b").select("a", "b", "a_tokens", "b_tokens").mapInArrow(run, "a bigint, b bigint")


def class_components(sets: DataFrame, prefix: DataFrame, percent: int, folder: str) -> DataFrame:
    """(cls, comp) of the classes that have a link; sets: written (cls, family, tokens), prefix: written (token, cls)."""
    large = written(block_counts(sets).where("blocks > 1").select("family"), folder, "large")
    if large.isEmpty():
        return block_components(sets, percent, folder)
    own = sets.join(large, "family", "left_semi").select("cls", "tokens")
    counted_ = prefix.join(set_counts(own), "cls").join(prefix.groupBy("token").agg(F.count(F.lit(1)).alias("k")), "token")
    shared = written(counted_, f"{folder}/large-families", "shared")
    hot = families(shared.where(F.col("k") > HOT).select("token", "cls"), f"{folder}/large-families")
    there = sets.join(large, "family", "left_anti").unionByName(own.join(hot, "cls").select("cls", "family", "tokens"))
    met = linked_components(shared.where(F.col("k") <= HOT).drop("k"), lambda pairs, _: _verified(pairs, own, percent), f"{folder}/large-families", lambda pairs: alike(pairs, percent))
    edges = block_components(there, percent, folder).unionByName(met).select(F.col("cls").alias("a"), F.col("comp").alias("b"))
    return connected_components(edges, folder, "cc").select(F.col("node").alias("cls"), F.col("component").alias("comp"))


def similar_classes(docs: DataFrame, words: int = 5, percent: int = 80, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(doc_id, n, cls) of every document, and (cls, component_id) of the classes that are not a document alone."""
    spark = docs.sparkSession
    folder = work_dir(spark)
    docs = docs.where("doc_id is not null")
    named = written(named_sets(docs, words, text), folder, "named")
    rows = named.where("kind = 0").select("doc_id", "n", "cls")
    order = spark.sparkContext.broadcast(crowding(named.where("kind = 1").select(F.col("doc_id").alias("chunk"), "counters")))  # COUNTERS bytes
    shared = written(shared_tokens(prefixes(docs, order, words, percent, text)), folder, "tokens")
    second = written(second_prefixes(shared, folder), folder, "prefixes")
    family = families(second, folder)
    classes = rows.where("cls is not null").groupBy("cls").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies"))
    classes = written(classes, folder, "classes")
    wanted = classes.join(family, "cls").select("doc_id", "cls", "family")
    sets = written(whole_sets(docs, written(wanted, folder, "wanted"), words, text), folder, "sets", "uncompressed")
    labels = class_components(sets, second, percent, folder)
    named_by = classes.join(labels, "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
    smallest = named_by.join(labels.select("comp").distinct(), "comp", "left_semi").groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    linked = named_by.join(smallest, "comp", "left").where("component_id is not null or copies > 1")
    return rows, linked.select("cls", F.coalesce("component_id", "doc_id").alias("component_id"))


def similar_documents(docs: DataFrame, words: int = 5, percent: int = 80, text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document with an id.

    component_id is the smallest doc_id reachable by links of Jaccard similarity of at least
    percent / 100; documents without words are linked with nothing; rows that repeat a doc_id
    each get a row. Rows with a null doc_id get a null component_id.
    """
    rows, linked = similar_classes(docs, words, percent, text)
    out = rows.join(linked, "cls", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
    nameless = docs.where("doc_id is null").select("doc_id", text)
    return out if nameless.isEmpty() else out.unionByName(named_sets(nameless, words, text).where("kind = 0").select("doc_id", F.col("n").alias("n_shingles"), F.lit(None).cast("bigint").alias("component_id")))
