import random

import pytest

WORDS = "the of and law act court state section shall person title code rule order public notice".split()


def sentence(rnd, n):
    return " ".join(rnd.choice(WORDS) + rnd.choice(["", "", ".", ",", "s", str(rnd.randint(0, 30))]) for _ in range(n))


@pytest.fixture(scope="session")
def corpus():
    """(doc_id, text, lang, source, n_chars): copies, near copies, shared passages, repeats, odd and empty texts, nulls."""
    rnd = random.Random(5)
    texts = [sentence(rnd, rnd.randint(1, 300)) for _ in range(60)]
    passage = sentence(rnd, 120)
    for i in range(8):
        texts.append(f"{sentence(rnd, 20)}\n{passage}\n{sentence(rnd, 30)}")
        texts.append(texts[i])  # exact copies
        words = texts[10 + i].split(" ")
        words[len(words) // 2] = f"edited{i}"
        texts.append(" ".join(words))  # near copies
    texts += ["", None, None, "   \n\t ", "one", "one two three", "ÉCOLE naïve ß 中文 😀 x", "12345 !!!", "a\x00b", "\n".join(["same line here again now"] * 40), "x" * 3000, "word " * 9000, texts[0], passage]
    langs = ["en", "fr", None, "en"]
    return [(None if i == 30 else i, t, langs[i % 4], ["a", "b", None, "hot", "hot", "hot"][i % 6], len(t) if t is not None else None) for i, t in enumerate(texts)]


SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def docs(spark, corpus):
    return spark.createDataFrame(corpus, SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def components(nodes, links):
    top = {n: n for n in nodes}

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        top[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}
