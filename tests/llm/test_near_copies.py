"""The joins by similarity against brute force: shingles, vectors, lines, windows, components."""

import hashlib
import itertools
import random
import re
import string
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexmill.llm import components as connected_module
from lexmill.llm import edits, line_dedup, ngram_join, vector_join, window_dedup
from lexmill.llm._common import work_dir
from lexmill.llm.candidates import linked_components
from lexmill.llm.components import connected_components
from lexmill.llm.shingles import shingle_sets
from lexmill.llm.sketch import COUNTERS
from tests.llm.conftest import components

WORD = re.compile(r"[^ \t-\r]+")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def shingles(text, n=5):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


def similar(sets, percent=80):
    return [(a, b) for a, b in itertools.combinations(sets, 2) if (i := len(sets[a] & sets[b])) and 100 * i >= percent * len(sets[a] | sets[b])]


def test_shingles_do_not_depend_on_their_neighbours(corpus):
    texts = [t or "" for _, t, *_ in corpus]
    together = shingle_sets(texts)
    for t, s in zip(texts, together):
        assert len(s) == len(shingles(t)) and (shingle_sets([t])[0] == s).all()


def test_ngram_join(docs, corpus):
    sets = {i: shingles(t) for i, t, *_ in corpus if i is not None}
    want = components(sets, similar(sets))
    got = ngram_join.similar_documents(docs.withColumn("cls", F.lit(1)).withColumn("n", F.lit("x")).withColumn("family", F.lit(2))).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == {i: (len(sets[i]), want[i]) for i in sets}
    assert len(got) == len(corpus) and [r.component_id for r in got if r.doc_id is None] == [None]


def test_ngram_join_large_family(spark, monkeypatch):
    """A family of many blocks, of which about a third of the pairs are linked, and repeated rows."""
    rnd = random.Random(1)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(160):
        words = list(base)
        for at in rnd.sample(range(150), rnd.choice([1, 2, 3, 6])):
            words[at] = f"e{i}x{at}"
        rows.append((i, " ".join(words)))
    rows += rows[:20]
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", 20)
    monkeypatch.setattr(ngram_join, "VISITORS", 7)
    sets = {i: shingles(t) for i, t in rows}
    want = components(sets, similar(sets))
    got = ngram_join.similar_documents(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert len(got) == 180 and {r.doc_id: r.component_id for r in got} == want


def test_ngram_join_chained_family(spark, monkeypatch):
    """Documents that each share a passage with the next are one family; what is compared follows their number, not its square, and links stay."""
    rnd = random.Random(2)
    parts = [" ".join(f"p{i}w{rnd.randint(0, 10**6)}" for _ in range(60)) for i in range(121)]
    rows = [(i, f"{parts[i]} {parts[i + 1]}") for i in range(120)]
    rows += [(200 + i, f"{rows[i][1]} more") for i in range(0, 120, 10)]
    seen, linked = [], ngram_join.linked
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", 20)
    monkeypatch.setattr(ngram_join, "HOT", 8)
    monkeypatch.setattr(ngram_join, "linked", lambda placed, percent: seen.append(placed.count()) or linked(placed, percent))
    sets = {i: shingles(t) for i, t in rows}
    got = ngram_join.similar_documents(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == components(sets, similar(sets))
    assert sum(seen) <= len(rows)


def test_ngram_join_hot_and_rare_tokens(spark, monkeypatch):
    """One family by tokens of many documents and by tokens of a few: both ways together lose no link."""
    rnd = random.Random(3)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(120):
        words = list(base)
        for at in rnd.sample(range(150), rnd.choice([1, 2, 3, 6])):
            words[at] = f"e{i % 40}x{at}"
        rows.append((i, " ".join(words)))
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", 20)
    monkeypatch.setattr(ngram_join, "VISITORS", 7)
    monkeypatch.setattr(ngram_join, "HOT", 3)
    sets = {i: shingles(t) for i, t in rows}
    got = ngram_join.similar_documents(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == components(sets, similar(sets))


def test_empty_tables(empty, spark):
    assert ngram_join.similar_documents(empty).count() == 0
    assert line_dedup.without_repeated_lines(empty).count() == 0
    assert window_dedup.window_digest(empty).count() == 0
    assert vector_join.similar_vectors(spark.createDataFrame([], "vec_id bigint, embedding array<float>")).count() == 0


def test_components(spark):
    rnd = random.Random(3)
    edges = [(rnd.randint(0, 400), rnd.randint(0, 400)) for _ in range(300)] + [(i, i + 1) for i in range(1000, 1100)] + [(5000, i) for i in range(6000, 6200)] + [(7, 7), (None, 3)]
    got = connected_components(spark.createDataFrame(edges, "a bigint, b bigint"), work_dir(spark)).collect()
    links = [(a, b) for a, b in edges if a is not None and a != b]
    nodes = {x for e in links for x in e}
    assert {r.node: r.component for r in got} == components(nodes, links)


def test_rounds_that_link_nothing_are_not_repeated(spark):
    """One token of 300 classes, of which no two are linked but the last ones asked for: one round of anchors that changes nothing is enough, and all pairs follow."""
    shared, turns = spark.range(300).selectExpr("7L as token", "id as cls"), []

    def verify(pairs, turn):
        turns.append((turn, pairs.count()))
        return pairs.where("a = 150 and b = 151")

    got = linked_components(shared, verify, work_dir(spark)).collect()
    assert {tuple(r) for r in got} == {(150, 150), (151, 150)}
    assert [turn for turn, _ in turns] == [0, 1, 2] and turns[-1][1] == 300 * 299 // 2


@pytest.mark.parametrize("kind", ["float", "double"])
def test_vectors(spark, monkeypatch, kind):
    rng = np.random.default_rng(4)
    centers = rng.normal(size=(5, 16))
    x = np.concatenate([c + rng.normal(size=(60, 16)) * s for c, s in zip(centers, (0.05, 0.2, 0.3, 0.4, 3))]).astype(np.float32)
    rows = [(i, [float(v) for v in e]) for i, e in enumerate(x)]
    rows += [(900 + i, rows[i][1]) for i in range(30)]
    rows += [(1000, None), (1001, [0.0] * 16), (1002, [float("nan")] + [1.0] * 15), (1003, [None] + [1.0] * 15), (1004, [1.0, 2.0]), (1005, []), (1006, [float("inf")] * 16)]
    monkeypatch.setattr(vector_join, "BLOCK", 40)
    got = vector_join.similar_vectors(spark.createDataFrame(rows, f"vec_id bigint, embedding array<{kind}>")).collect()
    good = {i: np.pad(np.array(e, float), (0, 16 - len(e))) for i, e in rows if e and all(v is not None and np.isfinite(v) for v in e) and any(e)}
    u = {i: v / np.linalg.norm(v) for i, v in good.items()}
    links = [(a, b) for a, b in itertools.combinations(u, 2) if u[a] @ u[b] >= 0.9]
    degree = Counter(v for link in links for v in link)
    want = components([i for i, _ in rows], links)
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == {i: (degree[i], want[i], want[i] == i) for i, _ in rows}


def test_windows(docs, corpus):
    size = 60
    texts = [(t or "").encode() for _, t, *_ in corpus]
    count = Counter(b[i : i + size] for b in texts for i in range(len(b) - size + 1))
    want = Counter()
    for (doc, *_), b in zip(corpus, texts):
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - size + 1):
            if count[b[i : i + size]] > 1:
                gone[i : i + size] = True
        spans = int(np.diff(gone.astype(int), prepend=0).clip(0).sum())
        want[(doc, len(b), int(gone.sum()), spans, hashlib.sha256(bytes(np.frombuffer(b, np.uint8)[~gone])).hexdigest())] += 1
    rows = window_dedup.without_repeats(docs.withColumn("hull", F.lit(1)).withColumn("spans", F.lit("x")), size)
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s["hi"] - s["lo"])
    got = rows.select("doc_id", "n_bytes", removed.alias("r"), F.size("spans").alias("s"), F.sha2("kept", 256).alias("h")).collect()
    assert Counter(map(tuple, got)) == want


def test_runs_cover_every_window_of_long_and_short_texts():
    rnd = random.Random(2)
    texts = [bytes(rnd.choice(b"ab ") for _ in range(n)) for n in (0, 399, 400, 401, 3000)] + [b"a" * 2000]
    for size in (1 << 18, 700):
        window_dedup.GROUP_BYTES, old = size, window_dedup.GROUP_BYTES
        try:
            seen = defaultdict(list)
            for row, start, n, *_ in window_dedup._runs_of(texts, 400):
                for r, s, m in zip(row.tolist(), start.tolist(), n.tolist()):
                    seen[r] += range(s, s + m)
        finally:
            window_dedup.GROUP_BYTES = old
        assert {i: list(range(max(0, len(t) - 399))) for i, t in enumerate(texts) if len(t) >= 400} == {k: sorted(v) for k, v in seen.items()}


def test_lines(spark, duck):
    rnd = random.Random(8)
    words = [f"word{i}" for i in range(400)]
    lines = [" ".join(rnd.choices(words, k=rnd.randint(2, 60))) for _ in range(120)]
    docs = []
    for i in range(80):
        own = [rnd.choice(lines) for _ in range(rnd.randint(1, 6))]
        if i % 3 == 0:  # an edit, another case, punctuation
            parts = own[0].split(" ")
            parts[-1] += "x"
            own[0] = " ".join(parts).upper() + "!"
        docs.append((i if i != 40 else None, "\n".join(own)))
    docs += [(200, None), (201, ""), (202, "\n\n"), (203, docs[0][1])]
    got = line_dedup.without_repeated_lines(spark.createDataFrame([(*d, "x") for d in docs], "doc_id bigint, text string, gone string")).collect()
    drop = str.maketrans({**dict.fromkeys(line_dedup.PUNCTUATION), **dict(zip("\t\r\x0b\x0c", "    "))})
    places = defaultdict(list)
    for i, t in docs:
        for at, line in enumerate((t or "").split("\n")):
            form = line.lower().translate(drop)
            if form.strip(" "):
                places[form].append((i if i is not None else -1, at))
    links = similar_lines(duck, list(places))
    assert links
    group = components(places, links)
    members = defaultdict(list)
    for form, top in group.items():
        members[top] += places[form]
    gone = {p for m in members.values() for p in sorted(m)[1:]}
    want = {(i, None if t is None else "\n".join(x for at, x in enumerate(t.split("\n")) if (i if i is not None else -1, at) not in gone)) for i, t in docs}
    assert {(r.doc_id, r.text) for r in got} == want
    assert {r.doc_id: r.n_removed for r in got if r.doc_id is not None} == {i: sum(p[0] == i for p in gone) for i, _ in docs if i is not None}


def removed(spark, docs):
    return {r.doc_id: (r.text, r.n_removed) for r in line_dedup.without_repeated_lines(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}


def test_lines_equal_all_pairs(spark, duck):
    """Lines of 1 to 200 words with one word replaced, and short ones with scattered edits, against every pair's edit similarity."""
    rnd = random.Random(12)
    word = lambda: "".join(rnd.choices(string.ascii_lowercase, k=rnd.randint(2, 9)))
    lines = []
    for n in (1, 2, 3, 4, 5, 6, 8, 10, 20, 50, 200):
        for _ in range(8):
            own = [word() for _ in range(n)]
            lines.append(" ".join(own))
            own[rnd.randrange(n)] = word()
            lines.append(" ".join(own))
    for n in range(9, 60):
        own = rnd.choices("ab cd", k=n)
        lines.append("".join(own))
        for at in range(rnd.randrange(10), n, 10):
            own[at] = rnd.choice(["", "x", own[at] + "y"])
        lines.append("".join(own))
    lines += ["".join(rnd.choices(string.ascii_lowercase, k=300))]
    lines += [lines[-1][:100] + "Z" + lines[-1][100:], lines[0], "read more", "Read more!"]
    rnd.shuffle(lines)
    forms = [x.lower().replace("!", "") for x in lines]
    duck.execute("CREATE OR REPLACE TEMP TABLE near AS SELECT unnest(?) AS line, generate_subscripts(?, 1) - 1 AS i", [forms, forms])
    links = duck.sql("SELECT a.i, b.i FROM near a JOIN near b ON a.i < b.i WHERE trim(a.line) <> '' AND trim(b.line) <> '' AND 10 * levenshtein(a.line, b.line) <= greatest(length(a.line), length(b.line))").fetchall()
    group = components(range(len(forms)), links)
    got = removed(spark, list(enumerate(lines)))
    assert {i for i in got if got[i][1]} == {i for i, top in group.items() if i != top}


def test_repeats_of_short_lines_go(spark):
    got = removed(spark, [(1, "Read more\nno no no no no no\nx\n\n!!"), (2, "read more.\nNo no no no no no\n\n!!\nX\nnew"), (3, "read more")])
    assert got == {1: ("Read more\nno no no no no no\nx\n\n!!", 0), 2: ("\n!!\nnew", 3), 3: ("", 1)}


def similar_lines(duck, forms):
    """Pairs of forms by every pair's edit similarity."""
    duck.execute("CREATE OR REPLACE TEMP TABLE near AS SELECT unnest(?) AS line", [forms])
    return duck.sql("SELECT a.line, b.line FROM near a JOIN near b ON a.line < b.line WHERE abs(length(a.line) - length(b.line)) * 10 <= greatest(length(a.line), length(b.line)) AND 10 * levenshtein(a.line, b.line) <= greatest(length(a.line), length(b.line))").fetchall()


def test_candidates_of_scattered_edits():
    """Of lines with one character in ten changed, however long, at least nine in ten share a token."""
    rnd = random.Random(3)
    order = np.zeros(COUNTERS, np.uint8)

    def tokens(lines):
        out = [set() for _ in lines]
        for line, token, _ in line_dedup.Lines(["\n".join(lines)]).tokens(order):
            for a, b in zip(line.tolist(), token.tolist()):
                out[a].add(b)
        return out

    for words in (4, 8, 10, 15, 20, 30, 50, 100):
        pairs = []
        for _ in range(200):
            line = " ".join("".join(rnd.choices(string.ascii_lowercase, k=rnd.randint(2, 9))) for _ in range(words))
            other = list(line)
            for at in rnd.sample(range(len(other)), len(other) // 10):
                other[at] = rnd.choice(["", "X", other[at] + "Y"])
            pairs.append((line, "".join(other)))
        found = [bool(a & b) for a, b in zip(tokens([a for a, _ in pairs]), tokens([b for _, b in pairs]))]
        assert sum(found) >= 0.9 * len(found), words


def test_lines_of_odd_characters():
    """Line numbers, lengths and names do not depend on what else is in the buffer."""
    texts = ["a\n\nb c\n", "", "\n \n", "é😀 x\nb c", "a" * 300]
    lines = line_dedup.Lines(texts)
    got = [(r, p, n) for r, p, n in zip(lines.row.tolist(), lines.pos.tolist(), lines.n.tolist())]
    assert got == [(0, 0, 1), (0, 2, 3), (3, 0, 4), (3, 1, 3), (4, 0, 300)]
    name = lines.name.tolist()
    assert name[1] == name[3] and len(set(name)) == 4
    assert line_dedup.Lines(texts[4:]).name.tolist() == name[4:]
    assert len(line_dedup.Lines([]).n) == 0


def test_edits_of_many_pairs(duck, monkeypatch):
    """Decisions against the whole table of edits, at every threshold around the distance; and grams never rule out a pair within it."""
    rnd = random.Random(6)
    pairs = [("", ""), ("", "ab"), ("abc", ""), ("a" * 50, "a" * 44), ("ab" * 40, "ba" * 40), ("x" + "é😀" * 20, "é😀" * 20)]
    for _ in range(400):
        a = rnd.choices("ab c" if rnd.random() < 0.5 else string.ascii_lowercase, k=rnd.randint(0, 120))
        b = list(a)
        for _ in range(rnd.choice([0, 1, 2, 5, 12, 30])):
            at = rnd.randint(0, len(b))
            b[at : at + rnd.randint(0, 2)] = rnd.choices("abxy", k=rnd.randint(0, 2))
        pairs.append(("".join(a), "".join(b)))
    duck.execute("CREATE OR REPLACE TEMP TABLE edited AS SELECT unnest(?) AS a, unnest(?) AS b", [[p[0] for p in pairs], [p[1] for p in pairs]])
    want = np.array([r[0] for r in duck.sql("SELECT levenshtein(a, b) FROM edited").fetchall()])
    text = edits.Buffer([t for p in pairs for t in p])
    a = 2 * np.arange(len(pairs))
    monkeypatch.setattr(edits, "CELLS", 3000)
    for off in (-3, -1, 0, 1, 7):
        most = np.maximum(want + off, 0)
        assert (edits.within(text, a, a + 1, most) == (want <= most)).all()
    assert not line_dedup._unlike(text, a, a + 1, want).any()


def test_passages_by_words(spark):
    """Words covered by strings of so many words that occur elsewhere too, against brute force; edits, overlaps, repeats in one text, nulls."""
    rnd = random.Random(21)
    vocabulary = [f"w{i}" for i in range(60)]
    passage = rnd.choices(vocabulary, k=30)
    texts = [None, "", "one two", " ".join(["so"] * 40), "  ".join(passage), " ".join(passage[:9]), " ".join(passage[5:16]).upper()]
    for i in range(40):
        words = rnd.choices(vocabulary, k=rnd.randint(0, 40))
        at = rnd.randint(0, len(words))
        a, b = sorted(rnd.sample(range(31), 2))
        texts.append("\n".join(words[:at] + passage[a:b] + words[at:]))
    n = 10
    own = [[w.lower() for w in WORD.findall(t or "")] for t in texts]
    seen = Counter(tuple(w[i : i + n]) for w in own for i in range(len(w) - n + 1))
    want = {d: len({k for i in range(len(w) - n + 1) if seen[tuple(w[i : i + n])] > 1 for k in range(i, i + n)}) for d, w in enumerate(own)}
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows = window_dedup.without_repeats(df.withColumn("passages", F.lit(1)), passage=n).select("doc_id", window_dedup.covered("passages").alias("n")).collect()
    assert {r.doc_id: r.n for r in rows} == want and sum(x > 0 for x in want.values()) > 20


def test_vectors_that_share_an_id(spark):
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.0]), (3, [0.99, 0.1]), (4, [0.1, 0.99]), (4, [0.1, 0.99]), (9, [-1.0, 0.0])]
    got = vector_join.similar_vectors(spark.createDataFrame([(*r, "x") for r in rows], "vec_id bigint, embedding array<double>, rep string")).collect()
    want = [(1, 2, 1), (1, 2, 1), (2, 2, 1), (3, 2, 1), (4, 2, 1), (4, 2, 1), (9, 0, 9)]
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == want


def test_lines_with_a_phrase_at_other_places_are_not_brought_together(spark):
    """A phrase that edits have spared lies at about the same place of both lines: elsewhere it makes no pair, and no token stays."""
    rnd = random.Random(29)
    phrase = "notwithstanding any other provision of this chapter"
    lines = []
    for i in range(24):
        own = "".join(rnd.choices(string.ascii_lowercase, k=250))
        lines.append(own[: 10 * i] + phrase + own[10 * i :])
    docs = spark.createDataFrame([(str(i), line) for i, line in enumerate([*lines, lines[3][:100] + "z" + lines[3][100:]])], "k string, text string")
    crowd = spark.sparkContext.broadcast(np.zeros(line_dedup.COUNTERS, np.uint8))
    brought = line_dedup.company(line_dedup.token_table(docs.coalesce(1), crowd, 3), 3)
    found = {frozenset((r["cls"], r["other"])) for r in brought.collect() if r["other"] is not None}
    name = line_dedup.Lines(["\n".join([*lines, lines[3][:100] + "z" + lines[3][100:]])]).name.tolist()
    assert brought.where("token is not null").isEmpty()
    assert frozenset((name[3], name[24])) in found
    assert len(found) <= 40  # neighbours by place only, of 300 pairs that share the phrase


@pytest.mark.parametrize("looked, near", [(256, 8), (2, 1), (1, 100)])
def test_lines_of_one_phrase_by_pairs_or_by_components(spark, duck, monkeypatch, looked, near):
    """Bounds of pairs a token decide how lines are compared, not which are removed."""
    monkeypatch.setattr(line_dedup, "LOOKED", looked)
    monkeypatch.setattr(line_dedup, "NEAR", near)
    rnd = random.Random(30)
    own = ["".join(rnd.choices(string.ascii_lowercase + " ", k=60)) for _ in range(4)]
    lines = []
    for i in range(60):
        line = list(own[i % 4])
        for at in rnd.sample(range(60), rnd.randint(1, 4)):
            line[at] = rnd.choice(string.ascii_lowercase)
        lines.append("".join(line))
    links = [(a, b) for a, b in similar_lines(duck, lines)]
    top = components(lines, links)
    first = {}
    for line in lines:
        first.setdefault(top[line], line)
    got = removed(spark, list(enumerate(lines)))
    assert [got[i][1] for i in range(60)] == [int(first[top[line]] != line) for line in lines]


@pytest.mark.parametrize("few", [0, 60, 10_000])
def test_components_with_few_edges_take_few_tables(spark, monkeypatch, few):
    """By contraction, by one task, and by one after the other: the same components; one task writes two tables, whatever the chains' length."""
    rnd = random.Random(31)
    path = rnd.sample(range(-500, 500), 300)
    edges = list(itertools.pairwise(path)) + [(1000 + rnd.randint(0, 99), 1000 + rnd.randint(0, 99)) for _ in range(60)] + [(None, 5), (9, 9)]
    names, kept = [], connected_module.written
    monkeypatch.setattr(connected_module, "FEW_EDGES", few)
    monkeypatch.setattr(connected_module, "written", lambda df, folder, name: names.append(name) or kept(df, folder, name))
    got = connected_components(spark.createDataFrame(edges, "a bigint, b bigint"), work_dir(spark)).collect()
    links = [(a, b) for a, b in edges if a is not None and a != b]
    assert {r.node: r.component for r in got} == components({x for e in links for x in e}, links) and len(got) == len({r.node for r in got})
    assert few < 10_000 or names == ["cc-edges-0", "cc-label-1"]


def test_bags_rule_chance_meetings_out_and_no_similar_pair(spark):
    """Lines of one phrase at one place and of other letters make no pair where tokens meet; of similar lines the bags always allow it."""
    rnd = random.Random(33)
    phrase = "this chapter shall "
    lines = [phrase + "".join(rnd.choices(string.ascii_lowercase, k=41)) for _ in range(12)]
    lines.append(lines[5][:30] + "x" + lines[5][31:])
    docs = spark.createDataFrame([(str(i), line) for i, line in enumerate(lines)], "k string, text string")
    crowd = spark.sparkContext.broadcast(np.zeros(line_dedup.COUNTERS, np.uint8))
    brought = line_dedup.company(line_dedup.token_table(docs.coalesce(1), crowd, 3), 3).collect()
    name = line_dedup.Lines(["\n".join(lines)]).name.tolist()
    assert {frozenset((r["cls"], r["other"])) for r in brought} == {frozenset((name[5], name[12]))}

    texts = []
    for _ in range(500):
        own = rnd.choices("ab cdeé" if rnd.random() < 0.5 else string.ascii_lowercase, k=rnd.randint(10, 400))
        other = list(own)
        for _ in range(len(own) // 10):
            at = rnd.randrange(len(other))
            other[at : at + rnd.randint(0, 1)] = rnd.choices("zab", k=rnd.randint(0, 1))
        texts += sorted(("x" + "".join(own), "x" + "".join(other)), key=len)
    some = line_dedup.Lines(["\n".join(texts)])
    i = 2 * np.arange(500)
    assert line_dedup.bags_allow(some.bags(), some.n, i, i + 1).all()


@pytest.mark.parametrize("looked, near", [(256, 8), (3, 8), (256, 1)])
def test_rows_of_one_token(monkeypatch, looked, near):
    """Pairs of like rows by token; those of a token with too many are the next rows only, and its rows stay."""
    monkeypatch.setattr(line_dedup, "LOOKED", looked)
    monkeypatch.setattr(line_dedup, "NEAR", near)
    rnd = np.random.default_rng(8)
    token, n = rnd.integers(0, 40, 600), rnd.integers(20, 60, 600) * rnd.choice([1, 1, 1, -1], 600)
    order = np.lexsort((n, token))
    token, n, place, bag = token[order], n[order], rnd.integers(-1, 6, 600), rnd.integers(0, 3, 600).astype("<u8")
    pairs, counts = defaultdict(list), Counter(token.tolist())
    like = defaultdict(set)
    for i, j in itertools.combinations(range(600), 2):
        if token[i] == token[j] and n[i] > 0 and n[j] - n[i] <= n[j] // 10:
            like[token[i]] |= {(i, j)}
            before = place[i] - place[j]
            apart = abs(before) + abs(n[i] - n[j] - before) <= n[j] // 10 or min(place[i], place[j]) < 0
            if j - i <= looked and apart and sum(abs((int(bag[i]) >> s & 15) - (int(bag[j]) >> s & 15)) for s in range(0, 64, 4)) <= 2 * (n[j] // 10):
                pairs[token[i]].append((i, j))
    many = {t for t in counts if len(pairs[t]) > near * counts[t] or any(j - i > looked for i, j in like[t])}
    i, j, stay = line_dedup.near_rows(token, n, place, bag)
    assert sorted(zip(i.tolist(), j.tolist())) == sorted(p for t in pairs for p in pairs[t] if t not in many or p[1] == p[0] + 1)
    assert set(np.flatnonzero(stay).tolist()) == {k for t in many for p in like[t] for k in p}


def test_rows_of_a_token_of_very_many_lines_are_not_all_held():
    rows = 20_000
    tracemalloc.start()
    i, j, stay = line_dedup.near_rows(np.zeros(rows, np.int64), np.full(rows, 50), np.zeros(rows, np.int64), np.zeros(rows, "<u8"))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(i) == rows - 1 and (j == i + 1).all() and stay.all()
    assert peak < 30e6  # all pairs looked at are 5 million, 16 bytes each
