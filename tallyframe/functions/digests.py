"""MD5 of many short texts at once, for draws that hash every row again and again."""

from __future__ import annotations

import math

import numpy as np

TURNS = ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21))
SINES = [int(abs(math.sin(i + 1)) * (1 << 32)) for i in range(64)]
WORD = [*range(16), *[(5 * i + 1) % 16 for i in range(16, 32)], *[(3 * i + 5) % 16 for i in range(32, 48)], *[7 * i % 16 for i in range(48, 64)]]
START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)
#: Texts that are hashed side by side, which fit a core's cache, and bytes of a text at most: one block of MD5.
SIDE_BY_SIDE, LONGEST = 8_192, 55


class Endings:
    """Texts of ASCII or UTF-8 that are hashed with one beginning after another."""

    def __init__(self, texts: list[str]):
        coded = [t.encode() for t in texts]
        self.parts = [_Part(coded[n : n + SIDE_BY_SIDE]) for n in range(0, len(coded), SIDE_BY_SIDE)]

    def heads(self, beginning: str) -> np.ndarray:
        """The first 64 bits of the MD5 of beginning + text for each text, as numbers in the order of the hexadecimal digests."""
        return np.concatenate([part.heads(beginning.encode()) for part in self.parts]) if self.parts else np.zeros(0, np.uint64)


class _Part:
    def __init__(self, coded: list[bytes]):
        self.lengths = np.array([len(t) for t in coded])
        self.letters = np.frombuffer(b"".join(t.ljust(self.lengths.max(), b"\0") for t in coded), np.uint8).reshape(len(coded), -1)
        self.known: dict[int, list] = {}

    def heads(self, begun: bytes) -> np.ndarray:
        first, n = len(begun), len(self.lengths)
        last = first + self.letters.shape[1]
        if last > LONGEST:
            raise ValueError(f"texts of over {LONGEST} bytes are not hashed here")
        if first not in self.known:
            block = np.zeros((n, 64), np.uint8)
            block[:, first:last] = self.letters
            block[np.arange(n), first + self.lengths] = 128
            words = block.view("<u4")
            words[:, 14] = 8 * (first + self.lengths)
            # Words that may hold letters, or tell the length, differ from text to text; the others are numbers.
            self.known[first] = [np.ascontiguousarray(words[:, w]) if w == 14 or first // 4 <= w <= last // 4 else 0 for w in range(16)]
        fixed = np.frombuffer(begun.ljust(64, b"\0"), "<u4").tolist()
        return _head([w | np.uint32(f) if isinstance(w, np.ndarray) else f for w, f in zip(self.known[first], fixed, strict=True)], n)


def _head(words: list, n: int) -> np.ndarray:
    a, b, c, d = (np.full(n, x, np.uint32) for x in START)
    f, t = np.empty(n, np.uint32), np.empty(n, np.uint32)
    for i in range(64):
        if i < 16:
            np.bitwise_xor(c, d, out=f)
            f &= b
            f ^= d
        elif i < 32:
            np.bitwise_xor(b, c, out=f)
            f &= d
            f ^= c
        elif i < 48:
            np.bitwise_xor(b, c, out=f)
            f ^= d
        else:
            np.invert(d, out=f)
            f |= b
            f ^= c
        f += a
        word = words[WORD[i]]
        if isinstance(word, np.ndarray):
            f += word
            word = 0
        f += np.uint32((SINES[i] + word) & 0xFFFFFFFF)
        turn = TURNS[i // 16][i % 4]
        np.left_shift(f, np.uint32(turn), out=t)
        f >>= np.uint32(32 - turn)
        f |= t
        f += b
        a, b, c, d, f = d, f, b, c, a
    a += np.uint32(START[0])
    b += np.uint32(START[1])
    return a.byteswap().astype(np.uint64) << np.uint64(32) | b.byteswap()
