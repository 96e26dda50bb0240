"""Sets of hashed word shingles of whole texts, computed over buffers of many texts at once."""

from __future__ import annotations

import numpy as np

GROUP_CHARS = 400_000
_BASE, _FOLD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_powers: dict[int, np.ndarray] = {}


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijection of 64-bit integers that spreads them; each salt gives another order."""
    with np.errstate(over="ignore"):
        x = x + np.uint64((0x9E3779B97F4A7C15 * (salt + 1)) & (2**64 - 1))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


_BYTE = mixed(np.arange(256, dtype=np.uint64), 7)
_BLANK = np.zeros(256, bool)
_BLANK[[32, *range(9, 14)]] = True


def powers(base: np.uint64, n: int) -> np.ndarray:
    """At least the first n powers of the base, by 64-bit arithmetic."""
    have = _powers.get(int(base))
    if have is None or len(have) < n:
        grown = np.full(max(n, 1 << 19), base, np.uint64)
        grown[0] = 1
        have = _powers[int(base)] = np.cumprod(grown)
    return have


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words of all texts, A-Z lower-cased; edges of each text's run)."""
    each = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b"\n".join([*each, b""]).lower(), np.uint8)
    first = np.cumsum([0, *(len(x) + 1 for x in each)])
    blank = _BLANK[data]
    edge = np.flatnonzero(np.diff(blank, prepend=True))
    start, stop = edge[::2], edge[1::2]
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * powers(_BASE, len(data))[: len(data)], out=sums[1:])
    hashes = mixed((sums[stop] - sums[start]) * powers(_INVERSE, len(data) + 1)[start])
    return hashes, np.searchsorted(start, first)


def shingle_sets(texts: list[str], words: int = 5) -> list[np.ndarray]:
    """Each text's sorted distinct shingles as 64-bit hashes; a text with fewer words is one shingle, one without words none."""
    h, edges = word_hashes(texts)
    g = h.copy()
    for k in range(1, words):
        g[:-k] = g[:-k] * _FOLD + h[k:]
    g = mixed(g, words)
    out = []
    for a, b in zip(edges.tolist(), edges[1:].tolist()):
        if b - a >= words:
            out.append(np.unique(g[a : b - words + 1]))
        elif b > a:
            one = np.uint64(b - a)
            for x in h[a:b]:
                one = np.uint64((int(one) * int(_FOLD) + int(x)) & (2**64 - 1))
            out.append(mixed(np.array([one]), words + 1))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def grouped(texts: list[str | None], most: int = GROUP_CHARS):
    """(first row, texts) of about so many characters each; null counts as empty."""
    group, size, first = [], 0, 0
    for i, t in enumerate(texts):
        group.append(t or "")
        size += len(group[-1])
        if size > most:
            yield first, group
            group, size, first = [], 0, i + 1
    if group:
        yield first, group


def set_id(tokens: np.ndarray) -> int:
    """A 64-bit name of a set of hashes."""
    return int((mixed(tokens, 3).sum(dtype=np.uint64) ^ mixed(np.array([len(tokens)], np.uint64), 4)[0]).astype(np.int64))
