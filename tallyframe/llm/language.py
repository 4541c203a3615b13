"""Language spans: script ranges, per-word scores and Viterbi with a switching penalty.

A word's script narrows the languages that can have written it. Each remaining language scores the word by the
log-likelihood of its character n-grams, and Viterbi finds the sequence of languages that is best after
paying a penalty for every switch. A document's language is that of most of its letters.

The model is trained from labelled texts: n-gram counts by language are summed on the executors over a sample
of labelled rows with a documented bound, and only a table of fixed size comes to the driver.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_bucket, map_slices, smallest_by_hash, spread



def code_points(*kinds: str) -> str:
    """Ranges, for a class of a pattern, of the code points whose category starts with one of kinds."""
    found = [c for c in range(0x80, 0x110000) if unicodedata.category(chr(c)).startswith(kinds)]
    starts = [i for i, c in enumerate(found) if not i or found[i - 1] != c - 1]
    return "".join(f"{chr(found[a])}-{chr(found[b - 1])}" for a, b in zip(starts, [*starts[1:], len(found)], strict=True))


#: Labelled rows that a model is trained from, at most: those with the smallest hashes of their ids.
TRAIN_ROWS = 6_000
#: Hashed character n-grams (of 1 to MAX_GRAM letters within a word and its bounds).
BUCKETS = 1 << 15
MAX_GRAM = 4
SWITCH_PENALTY = 12.0
#: A word speaks for or against a language by this much at most.
WORD_CAP = 8.0
#: A language is a candidate for a script if this share of its training letters is in it.
SCRIPT_SHARE = 0.02
UNKNOWN = "und"
#: Words a worker remembers the scores of, and words that Viterbi runs over side by side, with so few languages that SCORES allows it.
CACHE_WORDS = 300_000
BLOCK_WORDS = 400_000
#: Scores (of a word in a language) that a worker holds for either, about; a longer text is still taken whole.
SCORES = 3_000_000
#: Combining marks go with the letters before them. Python's word characters also hold numbers such as a half.
MARKS, NUMBERS = code_points("M"), code_points("No", "Nl")
HAS_MARK = re.compile(f"[{MARKS}]")
LETTERS = re.compile(rf"[^\W\d_{NUMBERS}]+")
MARKED_LETTERS = re.compile(rf"[^\W\d_{NUMBERS}](?:[^\W\d_{NUMBERS}]|[{MARKS}])*")
#: Texts without a character from U+0300 on, most of those in Latin script, have no marks and few numbers of that kind: a short class is much faster.
WIDE = re.compile("[\u0300-\U0010ffff]")
ASCII_LETTERS, LATIN_LETTERS = re.compile("[A-Za-z]+"), re.compile(r"[^\W\d_²³¹¼½¾]+")

#: First code points of script ranges, in order, and their scripts.
SCRIPT_STARTS = (0x0000, 0x0250, 0x0370, 0x0400, 0x0530, 0x0590, 0x0600, 0x0700, 0x0900, 0x0980, 0x0A00, 0x0E00, 0x0E80, 0x10A0, 0x1100, 0x1200, 0x1E00, 0x1F00, 0x2000, 0x3040, 0x3100, 0x3400, 0xA000, 0xAC00, 0xD7B0, 0xF900, 0xFB00, 0xFB50, 0xFF00, 0x20000)
SCRIPTS = ("latin", "other", "greek", "cyrillic", "armenian", "hebrew", "arabic", "other", "devanagari", "bengali", "indic", "thai", "southeast", "georgian", "hangul", "other", "latin", "greek", "other", "kana", "other", "han", "other", "hangul", "other", "han", "latin", "arabic", "other", "han")
SCRIPT_NAMES = tuple(dict.fromkeys(SCRIPTS))
SCRIPT_OF_RANGE = tuple(SCRIPT_NAMES.index(s) for s in SCRIPTS)


def word_pattern(text: str) -> re.Pattern:
    """Matches the runs of letters of this text, each with its combining marks."""
    if text.isascii():
        return ASCII_LETTERS
    if not WIDE.search(text):
        return LATIN_LETTERS
    return MARKED_LETTERS if HAS_MARK.search(text) else LETTERS


def words_of(text: str | None) -> list[str]:
    return word_pattern(text).findall(text) if text else []


def script_of(word: str) -> int:
    return SCRIPT_OF_RANGE[bisect_right(SCRIPT_STARTS, ord(word[0])) - 1]


def gram_buckets(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hash buckets of the words' n-grams, and the word that each is from."""
    text = "\x02" + "\x02".join(w.lower() for w in words) + "\x02"
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    bounds = points == 2
    owner = np.cumsum(bounds) - 1
    inner = np.cumsum(bounds)
    buckets, owners = [], []
    h = np.zeros(len(points), np.uint64)
    for n in range(1, MAX_GRAM + 1):
        m = len(points) - n + 1
        if m <= 0:
            break
        h = (h[:m] * np.uint64(1_000_003) + points[n - 1 :]) * np.uint64(0x9E3779B97F4A7C15)
        # A gram may start or end with a bound but not run across one, and is more than a bound.
        ok = (inner[n - 1 :] - inner[:m] - bounds[n - 1 :] <= 0) if n > 1 else ~bounds
        buckets.append((h[ok] >> np.uint64(40)).astype(np.int64) % BUCKETS)
        owners.append(owner[:m][ok])
    return np.concatenate(buckets), np.concatenate(owners)


class LanguageModel:
    """Log-likelihoods [bucket, language], candidates [script, language] and the languages' names."""

    def __init__(self, languages: list[str], counts: np.ndarray, scripts: np.ndarray):
        self.languages = languages
        grams = counts.astype(np.float64) + 0.2
        self.log = np.log(grams / grams.sum(0, keepdims=True)).astype(np.float32)
        total = scripts.sum(0, keepdims=True)
        self.allowed = scripts >= np.maximum(SCRIPT_SHARE * total, 1)
        self.readable = self.allowed.any(1).tolist()
        self.fallback = int(np.argmax(counts.sum(0))) if languages else -1
        self.cache_words = min(CACHE_WORDS, SCORES * 10 // max(1, len(languages)))
        self.block_words = min(BLOCK_WORDS, SCORES // max(1, len(languages)))

    def scores(self, words: list[str]) -> np.ndarray:
        """[language, word]: 0 for the best candidate, down to -WORD_CAP; alike for all if the script has no candidate."""
        buckets, owners = gram_buckets(words)
        out = np.zeros((len(words), len(self.languages)))
        if len(buckets):
            order = np.argsort(owners, kind="stable")
            found, first = np.unique(owners[order], return_index=True)
            out[found] = np.add.reduceat(self.log[buckets[order]].astype(np.float64), first, axis=0)
        allowed = self.allowed[[script_of(w) for w in words]]
        some = allowed.any(1, keepdims=True)
        out = np.where(allowed | ~some, out, -np.inf)
        out = np.maximum(out - out.max(1, keepdims=True), -WORD_CAP)
        return np.where(some, out, 0.0).T


class WordScores:
    """Scores of words by index, remembered between texts."""

    def __init__(self, model: LanguageModel):
        self.model, self.ids = model, {}
        self.table = np.zeros((len(model.languages), 1024), np.float32)

    def indexes(self, words: list[str]) -> np.ndarray:
        ids = self.ids
        found = list(map(ids.get, words))
        if None in found:
            new = list(dict.fromkeys(w for w, i in zip(words, found, strict=True) if i is None))
            start = len(ids)
            ids.update(zip(new, range(start, start + len(new)), strict=True))
            while self.table.shape[1] < len(ids):
                self.table = np.concatenate([self.table, np.zeros_like(self.table)], axis=1)
            for at in range(0, len(new), 20_000):
                part = new[at : at + 20_000]
                self.table[:, start + at : start + at + len(part)] = self.model.scores(part)
            found = [ids[w] for w in words]
        return np.array(found, np.int64)

    def trim(self) -> None:
        if len(self.ids) > self.model.cache_words:
            self.ids.clear()


def viterbi(table: np.ndarray, sequences: list[np.ndarray], penalty: float = SWITCH_PENALTY) -> list[np.ndarray]:
    """For each sequence of indexes into table [language, index], its best path of languages. Ties take the first language."""
    paths: list[np.ndarray] = [np.zeros(0, np.int32)] * len(sequences)
    order = sorted((i for i in range(len(sequences)) if len(sequences[i])), key=lambda i: -len(sequences[i]))
    if not order:
        return paths
    lengths = np.array([len(sequences[i]) for i in order])
    flat = np.concatenate([sequences[i] for i in order])
    offsets = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    active = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")
    # Only sequences that are still running are held: they stand first, since the longest come first.
    value = table[:, flat[offsets]].astype(np.float64)
    stays: list[np.ndarray] = []
    bests: list[np.ndarray] = []
    final = np.zeros(len(order), np.int32)
    for t in range(1, int(lengths[0])):
        n = int(active[t])
        if n < value.shape[1]:
            final[n : value.shape[1]] = value[:, n:].argmax(0)
            value = value[:, :n]
        best = value.argmax(0)
        leave = value[best, np.arange(n)] - penalty
        stay = value >= leave
        value = np.where(stay, value, leave) + table[:, flat[offsets[:n] + t]]
        stays.append(stay)
        bests.append(best.astype(np.int32))
    final[: value.shape[1]] = value.argmax(0)
    path = np.zeros(len(flat), np.int32)
    path[offsets + lengths - 1] = final
    now = final[: int(active[-1])].astype(np.int64)
    for t in range(int(lengths[0]) - 1, 0, -1):
        n = int(active[t])
        if n > len(now):
            now = np.concatenate([now, final[len(now) : n].astype(np.int64)])
        stay, best = stays[t - 1], bests[t - 1]
        now = np.where(stay[now, np.arange(n)], now, best)
        path[offsets[:n] + t - 1] = now
    for i, a, m in zip(order, offsets.tolist(), lengths.tolist(), strict=True):
        paths[i] = path[a : a + m]
    return paths


def train(docs: DataFrame, where=None, text: str = "text", label: str = "lang", id: str = "doc_id", rows: int = TRAIN_ROWS) -> LanguageModel:
    """A model from the rows of docs that `where` admits and whose label and text are not null, `rows` ids at most.

    It learns every language of those rows, so that its size is bounded by BUCKETS times their languages. Without such rows it knows none.
    """
    usable = docs.where(F.col(label).isNotNull() & F.col(text).isNotNull() & (F.lit(True) if where is None else where))
    chosen = smallest_by_hash(usable, id, rows, seed=5)
    sample = usable.join(F.broadcast(chosen), id, "left_semi").select(text, label)
    names = [r[0] for r in sample.groupBy(label).count().orderBy(F.desc("count"), label).collect()]

    def count(slices: Iterator[list[list]]) -> Iterator[list[list]]:
        grams: dict[str, np.ndarray] = {}
        scripts: dict[str, np.ndarray] = {}
        for texts, labels in slices:
            for t, l in zip(texts, labels, strict=True):
                words = words_of(t)
                if not words:
                    continue
                if l not in grams:
                    grams[l], scripts[l] = np.zeros(BUCKETS, np.int64), np.zeros(len(SCRIPT_NAMES), np.int64)
                for at in range(0, len(words), 100_000):
                    part = words[at : at + 100_000]
                    grams[l] += np.bincount(gram_buckets(part)[0], minlength=BUCKETS)
                    np.add.at(scripts[l], [script_of(w) for w in part], [len(w) for w in part])
        for l, g in grams.items():
            hit = np.nonzero(g)[0]
            more = np.nonzero(scripts[l])[0]
            yield [[l] * (len(hit) + len(more)), [*hit.tolist(), *(-1 - more).tolist()], [*g[hit].tolist(), *scripts[l][more].tolist()]]

    counted = map_slices(sample, count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    grams, scripts = np.zeros((BUCKETS, len(names))), np.zeros((len(SCRIPT_NAMES), len(names)))
    column = counted["lang"].map({l: i for i, l in enumerate(names)}).to_numpy(np.int64)
    bucket, n = counted["bucket"].to_numpy(np.int64), counted["n"].to_numpy(np.float64)
    grams[bucket[bucket >= 0], column[bucket >= 0]] = n[bucket >= 0]
    scripts[-1 - bucket[bucket < 0], column[bucket < 0]] = n[bucket < 0]
    return LanguageModel(names, grams, scripts)


def identify(docs: DataFrame, model: LanguageModel, text: str = "text", id: str = "doc_id", spans: bool = True) -> DataFrame:
    """One row for each row of docs: its id, lang_pred, score (the share of letters in that language), n_spans and, if asked for, spans.

    A null text, or one without a letter, is 'und' with score 0 and no spans, and so is every text if the model knows no language. A text whose scripts no language
    was trained in takes the most frequent one with score 0. spans: [start, end) in characters, and the language.
    Narrow; only id and text are read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(slices: Iterator[list[list]]) -> Iterator[list[list]]:
        model = shared.value
        names = np.array(model.languages, object)
        scores = WordScores(model)

        def close(ids: list, texts: list, found: list[np.ndarray], sizes: list[np.ndarray]) -> list[list]:
            preds, shares, counts, listed = [], [], [], []
            for t, path, size in zip(texts, viterbi(scores.table, found), sizes, strict=True):
                if not len(path) or not len(names):
                    preds.append(UNKNOWN)
                    shares.append(0.0)
                    counts.append(0)
                    listed.append([])
                    continue
                letters = np.bincount(path, weights=size[0], minlength=len(names))
                best = int(letters.argmax())
                if size[1]:
                    preds.append(model.languages[best])
                    shares.append(float(letters[best] / letters.sum()))
                else:
                    preds.append(model.languages[model.fallback])
                    shares.append(0.0)
                cuts = np.nonzero(np.diff(path))[0] + 1
                counts.append(len(cuts) + 1)
                if spans:
                    at = [m.span() for m in word_pattern(t).finditer(t)]
                    bounds = [0, *cuts.tolist(), len(path)]
                    listed.append([{"start": at[a][0], "end": at[b - 1][1], "lang": model.languages[path[a]]} for a, b in zip(bounds, bounds[1:], strict=False)])
            scores.trim()
            return [ids, preds, shares, counts, *([listed] if spans else [])]

        ids, texts, found, sizes, held = [], [], [], [], 0
        for more, slice_texts in slices:
            for i, t in zip(more, slice_texts, strict=True):
                words = words_of(t)
                index = scores.indexes(words) if len(names) else np.zeros(0, np.int64)
                known = any(model.readable[script_of(w)] for w in words) if len(index) else False
                ids.append(i)
                texts.append(t if spans else None)
                found.append(index)
                sizes.append((np.fromiter(map(len, words), np.int64, len(words)), known))
                held += len(words)
                if held >= model.block_words:
                    yield close(ids, texts, found, sizes)
                    ids, texts, found, sizes, held = [], [], [], [], 0
        if ids:
            yield close(ids, texts, found, sizes)

    kind = docs.schema[id].dataType.simpleString()
    return map_slices(spread(docs.select(id, text)), run, f"`{id}` {kind}, lang_pred string, score double, n_spans int" + ", spans array<struct<start:int,end:int,lang:string>>" * spans)


def held_out(id: str = "doc_id"):
    """Rows that no model may learn from; a row without an id is never learned from."""
    return F.coalesce(crc_bucket(id, 4) == 2, F.lit(True))


def keep_identified(docs: DataFrame, least: float = 0.5, text: str = "text", id: str = "doc_id") -> DataFrame:
    """docs without texts that have no letter and those where no language holds `least` of the letters.

    If docs have no label to learn from, nothing can be said against a text with letters, and all of those stay.
    """
    model = train(docs, ~held_out(id), text=text, id=id)
    verdict = verdict_column(docs.sparkSession.sparkContext.broadcast(model), least)
    return docs.where(verdict(F.col(text)))


def verdict_column(shared, least: float):
    """A column function from texts to whether one language holds `least` of their letters. shared: a broadcast model."""

    @F.pandas_udf("boolean")
    def keeps(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = shared.value
        scores = WordScores(model)
        for texts in batches:
            out: list[bool] = []
            found: list[np.ndarray] = []
            sizes: list[np.ndarray] = []

            def close() -> None:
                for size, path in zip(sizes, viterbi(scores.table, found), strict=True):
                    letters = np.bincount(path, weights=size) if len(path) else size
                    out.append(bool(len(size) and (not model.languages or letters.max() >= least * letters.sum())))
                found.clear()
                sizes.clear()
                scores.trim()

            held = 0
            for t in texts:
                words = words_of(t) if isinstance(t, str) else []
                found.append(scores.indexes(words) if model.languages else np.zeros(0, np.int64))
                sizes.append(np.fromiter(map(len, words), np.int64, len(words)))
                held += len(words)
                if held >= model.block_words:
                    close()
                    held = 0
            close()
            yield pd.Series(out)

    return keeps
