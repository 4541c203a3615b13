"""Byte-pair encoding and decoding by a segment tree.

A tokenizer file (a path is a parameter) names the normalisation, the split into words and the merges. Inside
a word a segment tree stands over the ranks of adjacent pairs. Its root names the leftmost pair of lowest
rank; a merge changes the pairs to its left and right and takes one leaf away, each in logarithmic time, until
no pair can be merged. A word of any length so takes O(n log n).
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import regex
from pyspark.sql import DataFrame

from .common import map_slices, spread

#: Words in each of the two generations whose encodings a worker remembers. Results do not depend on it.
CACHE_WORDS = 250_000
NONE = 1 << 60


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself where it is printable, else the next free one from U+0100."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {b: chr(b) for b in shown}
    for b in range(256):
        if b not in letters:
            letters[b] = chr(0x100 + len(letters) - len(shown))
    return [letters[b] for b in range(256)]


class PairTree:
    """Minimum of (rank, place) over the pairs that start at each place."""

    def __init__(self, keys: list[int]):
        self.size = size = 1 << max(0, (len(keys) - 1).bit_length())
        self.tree = tree = [NONE] * size + keys + [NONE] * (size - len(keys))
        for i in range(size - 1, 0, -1):
            a, b = tree[2 * i], tree[2 * i + 1]
            tree[i] = a if a < b else b

    def put(self, place: int, key: int) -> None:
        tree, i = self.tree, self.size + place
        tree[i] = key
        while i > 1:
            other = tree[i ^ 1]
            low = key if key < other else other
            i >>= 1
            if tree[i] == low:
                return
            tree[i] = key = low


class WordBpe:
    """Encoder and decoder for a tokenizer file of kind BPE with byte letters and an end-of-word suffix."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        vocab = model["vocab"]
        self.tokens = [""] * (max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]) + 1)
        for token, i in vocab.items():
            self.tokens[i] = token
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for token, i in self.special.items():
            self.tokens[i] = token
        self.cut = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        self.letters = byte_letters()
        self.vocab = vocab
        self.pairs = {}
        for rank, (a, b) in enumerate(model["merges"]):
            self.pairs.setdefault((vocab[a], vocab[b]), (rank, vocab[a + b]))
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        # \s is Unicode's White_Space in the file's own dialect; here it would also take U+001C to U+001F.
        white = r"\t-\r \x85\xa0  -     　"
        self.words = regex.compile(pattern.replace(r"[^\s", f"[^{white}").replace(r"\s", f"[{white}]")).findall
        self.known: dict[str, tuple[bytes, str]] = {}
        self.older: dict[str, tuple[bytes, str]] = {}

    def merge(self, ids: list[int]) -> list[int]:
        """ids after all merges, leftmost lowest rank first."""
        n, pairs = len(ids), self.pairs
        if n < 2:
            return ids
        shift = n.bit_length()
        mask = (1 << shift) - 1
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        get = pairs.get
        keys = [(found[0] << shift | i) if (found := get((ids[i], ids[i + 1]))) else NONE for i in range(n - 1)]
        if min(keys) == NONE:
            return ids
        tree = PairTree(keys)
        root, put = tree.tree, tree.put
        if tree.size == 1:
            return [pairs[ids[0], ids[1]][1]]
        while (low := root[1]) != NONE:
            i = low & mask
            j = after[i]
            ids[i] = new = get((ids[i], ids[j]))[1]
            ids[j] = -1
            after[i] = k = after[j]
            if j < n - 1:
                put(j, NONE)
            if k < n:
                before[k] = i
                found = get((new, ids[k]))
                put(i, (found[0] << shift | i) if found else NONE)
            else:
                put(i, NONE)
            if (h := before[i]) >= 0:
                found = get((ids[h], new))
                put(h, (found[0] << shift | h) if found else NONE)
        return [i for i in ids if i >= 0]

    def word(self, word: str) -> list[int]:
        """Ids of one word, a match of the pattern."""
        letters = self.letters
        units = [letters[b] for b in word.encode("utf-8", "surrogatepass")]
        units[-1] += self.suffix
        vocab = self.vocab
        return self.merge([vocab[u] for u in units if u in vocab])

    def normal(self, text: str) -> str:
        """NFC, then each character's own lower case (a final sigma is no special case)."""
        if text.isascii():
            return text.lower()
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def _lookup(self, word: str) -> tuple[bytes, str]:
        if not (found := self.older.get(word)):
            ids = self.word(word)
            found = b"".join([i.to_bytes(4, "little") for i in ids]), " ".join([self.tokens[i] for i in ids])
        if len(self.known) >= CACHE_WORDS:
            self.older, self.known = self.known, {}
        if len(word) < 64:
            self.known[word] = found
        return found

    def encode(self, text: str) -> tuple[bytes, str]:
        """Ids as little-endian 32-bit integers, and the decoded text: the tokens, joined by spaces, for a file without a decoder."""
        ids, shown = [], []
        for k, part in enumerate(self.cut.split(text) if self.cut and any(map(text.__contains__, self.special)) else [text]):
            if k % 2:
                found = [(self.special[part].to_bytes(4, "little"), part)]
            else:
                lookup = self._lookup
                found = [self.known.get(w) or lookup(w) for w in self.words(self.normal(part))]
            ids += [f[0] for f in found]
            shown += [f[1] for f in found if f[0]]
        return b"".join(ids), " ".join(shown)

    def decode(self, ids: list[int]) -> str:
        return " ".join(self.tokens[i] for i in ids)


@lru_cache(maxsize=4)
def tokenizer(path: str) -> WordBpe:
    return WordBpe(path)


def encode_texts(docs: DataFrame, path: str, text: str = "text", id: str = "doc_id", outputs: bool = True) -> DataFrame:
    """One row for each row of docs: its id, n_tokens, ids_sha256, decoded_sha256 and, if asked for, ids and decoded.

    path is a tokenizer file that every executor has. A null text counts as an empty one, with no tokens.
    Narrow, one pass; repeated rows give repeated results; other columns of docs are not read.
    """

    def run(slices: Iterator[list[list]]) -> Iterator[list[list]]:
        import numpy as np

        model = tokenizer(path)
        for ids, texts in slices:
            coded = [model.encode(t or "") for t in texts]
            out = [ids, [len(i) // 4 for i, _ in coded], [hashlib.sha256(i).hexdigest() for i, _ in coded], [hashlib.sha256(d.encode("utf-8", "surrogatepass")).hexdigest() for _, d in coded]]
            yield out + ([[np.frombuffer(i, "<u4").tolist() for i, _ in coded], [d for _, d in coded]] if outputs else [])

    kind = docs.schema[id].dataType.simpleString()
    return map_slices(spread(docs.select(id, text)), run, f"`{id}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded string" * outputs)
