"""Packing of token sequences by Karmarkar-Karp multiway differencing.

A document's ids are cut into full windows and a rest, the rest into pieces of at most MAX_PIECE ids. The pieces
of a block of documents are then dealt to k windows: each piece starts as a partial partition (one subset
holds it, the others are empty), and the two partial partitions of largest imbalance are merged again and again, the
fullest subset of one with the emptiest of the other. k starts at the fewest windows that could hold the
pieces and rises whenever a window would exceed its capacity.

Blocks are runs of rows within a partition, so that packing is one narrow pass. A task writes its partition's windows whole, so that a lost
executor costs only its tasks; where rows were dealt anew (spread()), a task that runs again may meet them in another order and pack other, equally valid windows.
"""

from __future__ import annotations

import base64
import heapq
import math
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import estimated_bytes, map_slices, spread

WINDOW = 2048
#: Longest piece of a rest; short pieces let differencing come close to equal windows.
MAX_PIECE = 512
#: Pieces in a block.
BLOCK_PIECES = 1024
#: The id that ends a document.
END_ID = 1
#: Bytes of input (by the optimizer's estimate) for one task, at least, where the session's cores are busy anyway.
TASK_BYTES = 2 << 20
LONG_RUN, PART_RUN = re.compile(r"\S{2000}"), re.compile(r"\S{1000}")


def differencing(sizes: list[int], k: int) -> list[list[int]]:
    """Indexes of sizes in k subsets of near-equal sums."""
    if k == 1 or not sizes:
        return [list(range(len(sizes)))] + [[] for _ in range(k - 1)]
    # A partial partition: the sums of its subsets that are not empty, in rising order, and for each a tree of indexes.
    heap = [(-s, n, [s], [n]) for n, s in enumerate(sizes)]
    heapq.heapify(heap)
    made = len(sizes)
    while len(heap) > 1:
        _, _, a_sums, a_sets = heapq.heappop(heap)
        _, _, b_sums, b_sets = heapq.heappop(heap)
        # The fullest subsets of one meet the empty ones of the other; so many of either meet one that is not empty.
        met = max(0, len(a_sums) + len(b_sums) - k)
        sums = [*b_sums[: met - 1 if met else None : -1], *map(int.__add__, a_sums[:met], b_sums[met - 1 :: -1] if met else []), *a_sums[met:]]
        sets = [*b_sets[: met - 1 if met else None : -1], *zip(a_sets[:met], b_sets[met - 1 :: -1] if met else [], strict=False), *a_sets[met:]]
        order = sorted(range(len(sums)), key=sums.__getitem__)
        sums = [sums[i] for i in order]
        least = sums[0] if len(sums) == k else 0
        heapq.heappush(heap, (least - sums[-1], made, sums, [sets[i] for i in order]))
        made += 1
    out = []
    for tree in heap[0][3]:
        leaves, rest = [], [] if tree is None else [tree]
        while rest:
            x = rest.pop()
            if isinstance(x, tuple):
                rest += x
            else:
                leaves.append(x)
        out.append(sorted(leaves))
    return [[] for _ in range(k - len(out))] + out


def pack_block(sizes: list[int], window: int = WINDOW) -> list[list[int]]:
    """Windows, as indexes of sizes, that none exceeds; every index is in one window. No size exceeds a window."""
    total = sum(sizes)
    k = max(1, math.ceil(total / window))
    while True:
        windows = differencing(sizes, k)
        over = max(sum(sizes[i] for i in w) for w in windows)
        if over <= window:
            return [w for w in windows if w]
        k += max(1, k * (over - window) // (2 * window))


class ByteTokenizer:
    """Ids as the tokenizers library gives them for a byte-level file, its special tokens recognised.

    The same vocabulary as tiktoken ranks serves the usual texts, five times as fast; a text with a very long run
    without white space goes to the library itself.
    """

    def __init__(self, json_path: str, ranks_path: str | None, pattern: str | None):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(json_path)
        self.special = {t.content: i for i, t in self.library.get_added_tokens_decoder().items()}
        self.fast = None
        if ranks_path and pattern:
            import tiktoken

            with open(ranks_path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> list[int]:
        if self.fast is None or any(t in text for t in self.special) or has_long_run(text):
            return self.library.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


def has_long_run(text: str) -> bool:
    """Whether 2,000 characters follow each other without white space: these hold a thousand that begin at a multiple of 1,000, so that texts without such are read in few places."""
    return any(PART_RUN.match(text, at) for at in range(0, len(text) - 999, 1000)) and LONG_RUN.search(text) is not None


@lru_cache(maxsize=2)
def byte_tokenizer(json_path: str, ranks_path: str | None = None, pattern: str | None = None) -> ByteTokenizer:
    return ByteTokenizer(json_path, ranks_path, pattern)


FIELDS = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack_documents(docs: DataFrame, json_path: str, ranks_path: str | None = None, pattern: str | None = None, text: str = "text", id: str = "doc_id", window: int = WINDOW, outputs: bool = True) -> DataFrame:
    """One row for each piece: the document's id, FIELDS and, if asked for, the piece's ids.

    A null or empty text is its end id alone. Rows with the same id are packed each on its own. sequence_id is
    unique over the whole result and offsets in a sequence run gapless from 0. Only id and text are read.
    Very small input partitions are joined (without a shuffle), since each ends with one part-filled window. Which pieces share a
    window, and its number, follow the input's partitions, hence its file layout; pieces themselves do not.
    """
    df = docs.select(id, text)
    few = max(1, math.ceil(estimated_bytes(df) / TASK_BYTES))
    df = spread(df).coalesce(few)

    def run(slices: Iterator[list[list]]) -> Iterator[list[list]]:
        model = byte_tokenizer(json_path, ranks_path, pattern)
        at = TaskContext.get().partitionId() << 33
        waiting: list[tuple] = []

        def rows(pieces: list[tuple]) -> list[list]:
            columns = [list(c) for c in zip(*pieces, strict=True)]
            return columns if outputs else columns[:-1]

        def close(block: list[tuple]) -> Iterator[list[list]]:
            nonlocal at
            out = []
            for members in pack_block([p[2] for p in block], window):
                offset = 0
                for i in members:
                    doc, start, length, crc, total, ids = block[i]
                    out.append((doc, start, length, crc, total, at, offset, ids))
                    offset += length
                at += 1
            yield rows(out)

        for doc_ids, texts in slices:
            full = []
            for doc, t in zip(doc_ids, texts, strict=True):
                ids = np.array(model.encode(t or "") + [END_ID], "<u4")
                n = len(ids)
                whole = n - n % window
                # The rest in pieces of equal length, none above MAX_PIECE.
                parts = math.ceil((n - whole) / min(MAX_PIECE, window))
                bounds = [*range(0, whole, window), *(whole + (n - whole) * i // max(1, parts) for i in range(parts)), n]
                for a, b in zip(bounds, bounds[1:], strict=False):
                    piece = ids[a:b]
                    row = doc, a, b - a, zlib.crc32(piece.tobytes()), n
                    kept = piece.tolist() if outputs else None
                    if b - a == window:
                        full.append((*row, at, 0, kept))
                        at += 1
                    else:
                        waiting.append((*row, kept))
            if full:
                yield rows(full)
            while len(waiting) >= 2 * BLOCK_PIECES:
                yield from close(waiting[:BLOCK_PIECES])
                del waiting[:BLOCK_PIECES]
        if waiting:
            yield from close(waiting)

    kind = docs.schema[id].dataType.simpleString()
    return map_slices(df, run, f"`{id}` {kind}, {FIELDS}" + ", ids array<int>" * outputs)
