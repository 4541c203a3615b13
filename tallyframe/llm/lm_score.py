"""Stupid-backoff scores from n-gram count tables partitioned by hash.

Documents are dealt to batches. A batch explodes its texts into n-grams of all orders and sends each distinct one, with
its count there, to the bucket of its order and hash. A bucket sums the counts of all batches, which is its part of the
count table, and joins them back to the batches that asked. Each batch then scores its documents and sums per document.

N-grams travel as sorted 64-bit hashes in packed blocks, one for each batch and bucket, and their counts come
back in the same order, so that no n-gram is sent twice by a batch and no frequent one is a hot key. A document is scored
by the counts of all other documents (its own are taken off), so that unseen n-grams back off. Texts move once, compressed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import partitions_for

ORDER = 3
ALPHA = 0.4
#: Bytes of input (by the optimizer's estimate) in a batch, and in a bucket.
BATCH_BYTES = 10 << 20
BUCKET_BYTES = 8 << 20
CACHE_WORDS = 300_000
#: Words whose n-grams are held before their distinct ones are counted.
HELD_WORDS = 1 << 20


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def ngram_hashes(words: np.ndarray, order: int) -> list[np.ndarray]:
    """Hashes of the 1-grams to order-grams that start at each place, from the words' hashes. 0 is left free."""
    out = []
    h = np.zeros(len(words), np.uint64)
    for n in range(1, order + 1):
        m = max(0, len(words) - n + 1)
        h = (h[:m] ^ words[n - 1 :]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        h = h * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(n)
        h ^= h >> np.uint64(32)
        out.append(np.maximum(h, np.uint64(1)))
    return out


def pack(values: np.ndarray) -> bytes:
    """Byte planes, compressed: high planes of small numbers cost next to nothing."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes())


def unpack(data: bytes, kind: str) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).reshape(-1)


def word_hashes(texts: list[str | None]) -> list[np.ndarray]:
    """Hashes of each text's words."""
    cache, out = WordHashes(), []
    for t in texts:
        words = (t or "").encode("utf-8", "surrogatepass").split()
        out.append(np.fromiter(map(cache.__getitem__, words), np.uint64, len(words)))
    return out


def ngram_counts(docs: list[np.ndarray], order: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each order up to `order`: sorted distinct n-grams of the documents, and their counts."""
    held: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(order)]
    at = 0
    while at < len(docs):
        end, n = at, 0
        while end < len(docs) and (n == 0 or n + len(docs[end]) <= HELD_WORDS):
            n += len(docs[end])
            end += 1
        hashes = [ngram_hashes(d, order) for d in docs[at:end]]
        for k in range(order):
            held[k].append(np.unique(np.concatenate([h[k] for h in hashes]), return_counts=True))
        at = end
    return [merged(parts) for parts in held]


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys of sorted parts (keys, counts), and the sums of their counts."""
    if len(parts) == 1:
        return parts[0]
    keys, counts = (np.concatenate(c) for c in zip(*parts, strict=True)) if parts else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.nonzero(np.concatenate(([True], keys[1:] != keys[:-1])))[0] if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def score_document(hashes: list[np.ndarray], counts: list[np.ndarray], total: int, alpha: float) -> tuple[float, int, int]:
    """Sum of log scores, words whose longest n-gram was unseen elsewhere, and words unseen elsewhere.

    counts: over all documents, aligned with hashes. Own counts are taken off here.
    """
    n = len(hashes[0])
    if not n:
        return 0.0, 0, 0
    others = []
    for h, c in zip(hashes, counts, strict=True):
        _, inverse, own = np.unique(h, return_inverse=True, return_counts=True)
        others.append(c - own[inverse])
    rest = total - n
    seen = others[0] > 0
    score = np.where(seen, np.log(np.maximum(others[0], 1) / max(rest, 1)), math.log(alpha / (rest + 1)))
    backed = np.zeros(n, bool)
    for k in range(1, len(hashes)):
        m = len(hashes[k])
        if not m:
            break
        hit = others[k] > 0
        score[k:] = np.where(hit, np.log(np.maximum(others[k], 1) / np.maximum(others[k - 1][:m], 1)), math.log(alpha) + score[k:])
        backed[k:] = ~hit
    return float(score.sum()), int(backed.sum()), int((~seen).sum())


def stupid_backoff(docs: DataFrame, order: int = ORDER, alpha: float = ALPHA, text: str = "text", id: str = "doc_id") -> DataFrame:
    """One row for each row of docs: its id, n_words, n_backed_off, n_unseen, log_score (natural, summed), mean_log_score.

    Words are runs of characters other than U+0020 and U+0009 to U+000D. A null or empty text has no words, log_score 0 and
    a null mean. A repeated row is another document. Only id and text are read. n-grams are told apart by 64-bit
    hashes. One shuffle of texts to batches (used twice), one of the packed n-grams and one of the counts.
    Rows alike in id and text are dealt by their input partitions, so that no batch gets more than one partition's copies.
    """
    batches = partitions_for(docs.select(text), BATCH_BYTES)
    buckets = partitions_for(docs.select(text), BUCKET_BYTES)
    kind = docs.schema[id].dataType.simpleString()
    rows = docs.select(F.col(id).alias("doc"), F.col(text).alias("body"), F.pmod(F.xxhash64(id, text, F.spark_partition_id()), F.lit(batches)).cast("int").alias("batch"))

    def deal(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            batch = part.column("batch").to_numpy()
            at = np.argsort(batch, kind="stable")
            cuts = np.nonzero(np.diff(batch[at]))[0] + 1
            groups = np.split(at, cuts) if len(at) else []
            blocks = [to_block(part.select(["doc", "body"]).take(pa.array(g))) for g in groups]
            yield pa.RecordBatch.from_arrays([pa.array([batch[g[0]] for g in groups], pa.int32()), pa.array(blocks, pa.binary())], names=["batch", "block"])

    def ask(key: tuple, parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs_of = [w for part in parts for block in part.column("block").to_pylist() for w in word_hashes(from_block(block).column("body").to_pylist())]
        for k, (keys, counts) in enumerate(ngram_counts(docs_of, order)):
            bucket = bucket_of(keys, buckets)
            cuts = [0, *(np.nonzero(np.diff(bucket))[0] + 1).tolist(), len(keys)] if len(keys) else [0]
            rows = [(key[0].as_py(), k, int(bucket[a]), pack(np.diff(keys[a:b], prepend=np.uint64(0))), pack(counts[a:b].astype("<u4"))) for a, b in zip(cuts, cuts[1:], strict=False)]
            # All words are one more n-gram, of order 0.
            rows += [(key[0].as_py(), -1, 0, pack(np.ones(1, "<u8")), pack(np.array([sum(map(len, docs_of))], "<u4")))] * (k == 0)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()), strict=True)] if rows else [pa.array([], t) for t in (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary())], names=["batch", "n", "bucket", "keys", "counts"])

    def answer(key: tuple, table: pa.Table) -> pa.Table:
        keys = [np.cumsum(unpack(k, "<u8"), dtype=np.uint64) for k in table.column("keys").to_pylist()]
        ends = np.cumsum([len(k) for k in keys])
        inverse = np.unique(np.concatenate(keys), return_inverse=True)[1]
        counts = np.concatenate([unpack(c, "<u4") for c in table.column("counts").to_pylist()])
        sums = np.bincount(inverse, weights=counts).astype("<u8")[inverse]
        return pa.table({"batch": table.column("batch"), "n": table.column("n"), "bucket": table.column("bucket"), "sums": pa.array([pack(x) for x in np.split(sums, ends[:-1])], pa.binary())})

    def score(key: tuple, docs_of: pa.Table, answers: pa.Table) -> pa.Table:
        tables = [from_block(b) for b in docs_of.column("block").to_pylist()]
        ids = pa.chunked_array([c for t in tables for c in t.column("doc").chunks], tables[0].schema.field("doc").type) if tables else pa.array([])
        found = [word_hashes(t.column("body").to_pylist()) for t in tables]
        words = [w for part in found for w in part]
        sums: dict[int, list[bytes]] = {}
        for n, _, block in sorted(zip(answers.column("n").to_pylist(), answers.column("bucket").to_pylist(), answers.column("sums").to_pylist(), strict=True)):
            sums.setdefault(n, []).append(block)
        total = int(unpack(sums[-1][0], "<u8")[0]) if sums else 0
        hashes = [ngram_hashes(w, order) for w in words]
        counts: list[list[np.ndarray]] = [[] for _ in words]
        for k in range(order):
            table = np.concatenate([np.zeros(0, "<u8"), *[unpack(b, "<u8") for b in sums.pop(k, [])]]).astype(np.int64)
            flat = np.concatenate([np.zeros(0, np.uint64), *[h[k] for h in hashes]])
            each = table[np.unique(flat, return_inverse=True)[1]]
            for mine, part in zip(counts, np.split(each, np.cumsum([len(h[k]) for h in hashes])[:-1]) if hashes else (), strict=True):
                mine.append(part)
        out = [(len(w), *score_document(h, c, total, alpha)) for w, h, c in zip(words, hashes, counts, strict=True)]
        n, logs, backed, unseen = (list(c) for c in zip(*out, strict=True)) if out else ([], [], [], [])
        return pa.table({"doc": ids, "n_words": pa.array(n, pa.int64()), "n_backed_off": pa.array(backed, pa.int64()), "n_unseen": pa.array(unseen, pa.int64()), "log_score": pa.array(logs, pa.float64()), "mean_log_score": pa.array([s / m if m else None for s, m in zip(logs, n, strict=True)], pa.float64())})

    dealt = rows.mapInArrow(deal, "batch int, block binary").repartition(batches, "batch")
    asked = dealt.groupBy("batch").applyInArrow(ask, "batch int, n int, bucket int, keys binary, counts binary")
    answers = asked.repartition(buckets, "n", "bucket").groupBy("n", "bucket").applyInArrow(answer, "batch int, n int, bucket int, sums binary")
    scored = dealt.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(score, f"doc {kind}, n_words long, n_backed_off long, n_unseen long, log_score double, mean_log_score double")
    return scored.withColumnRenamed("doc", id)


def to_block(rows: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(rows)
    return sink.getvalue().to_pybytes()


def from_block(block: bytes) -> pa.Table:
    return pa.ipc.open_stream(block).read_all()


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Ranges of the hash, so that sorted keys fall into buckets in order."""
    return np.minimum((keys >> np.uint64(32)).astype(np.float64) * (buckets / 2.0**32), buckets - 1).astype(np.int64)
