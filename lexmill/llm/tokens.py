"""Token ids of whole texts by a public tokenizer file, with a bounded cache of words.

Both vocabularies split a text before merging and never merge across the split, so each
part may be encoded apart. Texts of ASCII and Latin letters are cut, as one buffer of bytes,
where the class of character changes; equal parts are numbered by Arrow, each distinct part
is looked up in the worker's cache or encoded by the tokenizers library, and the ids are
gathered in numpy. Other texts, and those with the string of an added token, are encoded whole.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np

#: Entries of each of a worker's two caches, the longest part kept, and characters cut at a time.
CACHE_WORDS, CACHE_CHARS, GROUP_CHARS = 900_000, 64, 6_000_000
#: Characters beyond ASCII without U+001C to U+001F and the Latin-1 letters.
OTHER = re.compile("[^\x00-\x1b -~\xc0-\xd6\xd8-\xf6\xf8-\xff]")
#: The ones of them in ASCII.
CONTROLS = "\x1c\x1d\x1e\x1f\x7f"
#: Classes of bytes: blank 0, letter 1 (with all bytes of Latin-1 letters), digit 2, other 3, apostrophe 4.
CLASS = np.full(256, 3, np.uint8)
CLASS[[32, *range(9, 14)]] = 0
CLASS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
CLASS[range(48, 58)] = 2
CLASS[39] = 4

_encoders: dict[str, "Encoder"] = {}


class Encoder:
    def __init__(self, file: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(file)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]  # found anywhere in a text
        self.lower = "Lowercase" in str(self.tokenizer.normalizer)
        # Byte-level files never split letters and the blank before them, so words need not go through
        # the pattern that splits; the others mark the last id of a word, and many are encoded as one text.
        if self.lower:
            vocab = self.tokenizer.get_vocab()
            self.ends = np.zeros(max(vocab.values()) + 1, bool)
            self.ends[[i for w, i in vocab.items() if w.endswith("</w>")]] = True
        else:
            self.unsplit = Tokenizer.from_file(file)
            self.unsplit.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def whole(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def words(self, words: list[str]) -> list[bytes]:
        """The ids of words of letters, with at most one blank before each."""
        if not words:
            return []
        if not self.lower:
            return [array("I", e.ids).tobytes() for e in self.unsplit.encode_batch_fast(words, add_special_tokens=False)]
        (got,) = self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)
        ids = np.array(got.ids, "<u4")
        data = ids.tobytes()
        stop = (4 * np.flatnonzero(self.ends[ids]) + 4).tolist()
        if len(stop) != len(words):
            return self.whole(words)
        return [data[a:b] for a, b in zip([0, *stop[:-1]], stop)]

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers; a null text has none."""
        out = [b""] * len(texts)
        group: list[int] = []
        size = 0
        for i, text in enumerate(texts):
            if not text:
                continue
            if (any(c in text for c in CONTROLS) if text.isascii() else OTHER.search(text)) or any(t in text for t in self.added):
                out[i] = self.whole([text])[0]
                continue
            group.append(i)
            size += len(text)
            if size > GROUP_CHARS:
                self.fill(texts, group, out)
                group, size = [], 0
        if group:
            self.fill(texts, group, out)
        return out

    def fill(self, texts: list[str | None], group: list[int], out: list[bytes]) -> None:
        import pyarrow as pa

        each = [texts[i].encode() for i in group]
        data = b"".join(each)
        if self.lower:
            data = data.lower()
        first = np.cumsum([0, *map(len, each)])
        kind = np.frombuffer(data.translate(CLASS.tobytes()), np.uint8)
        cut = np.zeros(len(data), bool)
        before, now = kind[:-1], kind[1:]
        np.logical_and((now != before) & (before != 0), (now == 0) | ((now != 4) & (before != 4)), out=cut[1:])
        cut[first[:-1]] = True
        start = np.flatnonzero(cut)
        offsets = np.append(start, len(data)).astype(np.int32)
        parts = pa.StringArray.from_buffers(len(start), pa.py_buffer(offsets), pa.py_buffer(data)).dictionary_encode()
        index = parts.indices.to_numpy()
        values = self.values(parts.dictionary.to_numpy(zero_copy_only=False).tolist())
        size = np.fromiter(map(len, values), np.int64, len(values)) // 4
        flat, base = np.frombuffer(b"".join(values), "<u4"), np.cumsum(size) - size
        n = size[index]
        upto = np.cumsum(n)
        ids = flat[np.repeat(base[index] - upto + n, n) + np.arange(int(upto[-1]))].tobytes()
        edge = (4 * np.append(0, upto)[np.append(np.searchsorted(start, first[:-1]), len(start))]).tolist()
        for i, a, b in zip(group, edge, edge[1:]):
            out[i] = ids[a:b]

    def values(self, words: list[str]) -> list[bytes]:
        """The ids of distinct parts, from the caches as far as they are known."""
        known, older = self.known, self.older
        out = list(map(known.get, words))
        miss = [i for i, v in enumerate(out) if v is None]
        fresh, mixed = [], []
        for i in miss:
            w = words[i]
            if (v := older.get(w)) is not None:
                known[w] = out[i] = v
            elif w.isalpha() or (w[0] == " " and w[1:].isalpha()):
                fresh.append(i)
            else:
                mixed.append(i)
        for lo in range(0, len(fresh), 500):
            self.keep(fresh[lo : lo + 500], self.words([words[i] for i in fresh[lo : lo + 500]]), words, out)
        self.keep(mixed, self.whole([words[i] for i in mixed]), words, out)
        if len(known) > CACHE_WORDS:
            self.known, self.older = {}, known
        return out

    def keep(self, at: list[int], values: list[bytes], words: list[str], out: list[bytes]) -> None:
        for i, v in zip(at, values):
            out[i] = v
            if len(words[i]) <= CACHE_CHARS:
                self.known[words[i]] = v


def encoder(file: str) -> Encoder:
    """The worker's encoder of a tokenizer file."""
    if file not in _encoders:
        _encoders[file] = Encoder(file)
    return _encoders[file]


def forget() -> None:
    """Drop this worker's tokenizers and caches, for later work in the same process."""
    _encoders.clear()


def public_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
