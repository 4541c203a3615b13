"""License scans by a positional index of rare words.

Templates are phrases and notices. Their words are the licence words; a first pass counts in how many documents each of
these stands, which gives their IDF. In a second pass each file looks up, for every template, those licence words it has that
are rarest: the postings (positions in the template) of each say where the template would begin in the file, and only beginnings on which
they agree are left. There the mandatory key phrases are verified, and the template scores by the share of its words, weighted by
IDF, that stand where they should.

Both passes are narrow; what is gathered is one count for each licence word. A text is held as one number for each of its words.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_slices, spread, word_pieces

#: Rare words of a template that a file looks up.
LOOKED_UP = 3
COLUMNS = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


def words_of(text: str) -> list[bytes]:
    return [w for piece in word_pieces(text) for w in piece]


@dataclass(frozen=True)
class Template:
    """A label, the text that stands for it, phrases that must stand in it, and by how many words its parts may be shifted against each other."""

    label: str
    text: str
    keys: tuple[str, ...]
    slack: int = 0


def phrase(label: str, text: str) -> Template:
    return Template(label, text, (text,))


#: Phrases and the labels that they give.
BASE = (
    phrase("gpl", "gnu general public license"),
    phrase("apache", "apache license"),
    phrase("cc-by", "cc by"),
    phrase("mit", "mit license"),
)

#: Notices beyond the base phrases: names with versions, and grants that name no licence.
NOTICES = (
    Template("gpl-3.0", "licensed under the gnu general public license version 3", ("gnu general public license", "version 3"), 4),
    Template("gpl-2.0", "licensed under the gnu general public license version 2", ("gnu general public license", "version 2"), 4),
    Template("lgpl", "licensed under the gnu lesser general public license", ("gnu lesser general public license",), 4),
    Template("agpl", "licensed under the gnu affero general public license", ("gnu affero general public license",), 4),
    Template("apache-2.0", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license", ("apache license", "version 2 0"), 6),
    Template("cc-by-nc", "this work is licensed under cc by nc 4 0", ("cc by nc",), 4),
    Template("cc-by-sa", "this work is licensed under cc by sa 4 0", ("cc by sa",), 4),
    Template("cc-by-nd", "this work is licensed under cc by nd 4 0", ("cc by nd",), 4),
    Template("cc-by", "this work is licensed under a creative commons attribution 4 0 international license", ("creative commons attribution", "license"), 4),
    Template("cc0", "to the extent possible under law the author has waived all copyright and related rights cc0 1 0 universal", ("cc0",), 6),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", ("permission is hereby granted free of charge", "obtaining a copy"), 6),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("permission to use copy modify", "with or without fee"), 6),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ("redistribution and use in source and binary forms",), 6),
    Template("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license",), 6),
    Template("unlicense", "this is free and unencumbered software released into the public domain", ("free and unencumbered software",), 6),
)


class Index:
    """Licence words by number and, for each template, its words and the positions of each. `idf` is by word number."""

    def __init__(self, base: tuple[Template, ...] = BASE, more: tuple[Template, ...] = NOTICES):
        self.base, self.templates = len(base), (*base, *more)
        texts = [words_of(t.text) for t in self.templates]
        keys = [[words_of(k) for k in t.keys] for t in self.templates]
        if any(not k for ks in keys for k in ks) or not all(texts) or not all(keys):
            raise ValueError("a template needs words and key phrases")
        self.words = sorted({w for x in [*texts, *(k for ks in keys for k in ks)] for w in x})
        self.number = {w: i for i, w in enumerate(self.words)}
        self.texts = [np.array([self.number[w] for w in t]) for t in texts]
        self.keys = [[np.array([self.number[w] for w in k]) for k in ks] for ks in keys]
        #: Without the words of its keys no file holds a template.
        self.needed = [set(np.concatenate(ks).tolist()) for ks in self.keys]
        self.postings = [{w: np.nonzero(t == w)[0] for w in set(t.tolist())} for t in self.texts]
        self.weigh({}, 0)

    def weigh(self, documents_of: dict[int, int], documents: int) -> None:
        self.idf = np.array([math.log((documents + 1) / (documents_of.get(i, 0) + 1)) for i in range(len(self.words))])
        #: Template words from the rarest on.
        self.rarest = [sorted(p, key=lambda w: (-self.idf[w], w)) for p in self.postings]

    def numbers(self, text: str | None) -> np.ndarray:
        """The number of each word of a text, -1 where it is no licence word."""
        get = self.number.get
        parts = [np.fromiter((get(w, -1) for w in piece), np.int32, len(piece)) for piece in word_pieces(text)]
        return np.concatenate(parts) if parts else np.zeros(0, np.int32)


class File:
    """Where the licence words of one text stand."""

    def __init__(self, numbers: np.ndarray):
        self.numbers = numbers
        self.at = np.nonzero(numbers >= 0)[0]
        self.found = numbers[self.at]
        self.present = set(np.unique(self.found).tolist())
        self._places: dict[int, np.ndarray] = {}

    def places(self, word: int) -> np.ndarray:
        if word not in self._places:
            self._places[word] = self.at[self.found == word]
        return self._places[word]

    def phrase(self, words: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Those of starts at which the words stand consecutively."""
        starts = starts[(starts >= 0) & (starts + len(words) <= len(self.numbers))]
        for i, w in enumerate(words.tolist()):
            starts = starts[self.numbers[starts + i] == w]
        return starts


@dataclass
class Match:
    template: int
    start: int
    share: float


def near(sorted_values: np.ndarray, x: np.ndarray, slack: int) -> np.ndarray:
    """Whether a value lies within slack of each x."""
    return np.searchsorted(sorted_values, x + slack, "right") > np.searchsorted(sorted_values, x - slack, "left")


def aligned(index: Index, t: int, file: File) -> np.ndarray:
    """Where template t may begin: beginnings that follow from its rarest words in the file and on which over half of these agree within its slack."""
    slack = index.templates[t].slack
    looked = [w for w in index.rarest[t] if w in file.present][:LOOKED_UP]
    starts = [np.unique((file.places(w)[:, None] - index.postings[t][w][None]).ravel()) for w in looked]
    if not slack:
        out = starts[0]
        for other in starts[1:]:
            out = np.intersect1d(out, other, assume_unique=True)
        return out
    every = np.unique(np.concatenate(starts))
    votes = sum(near(s, every, slack).astype(int) for s in starts)
    return every[2 * votes > len(starts)]


def matches(index: Index, file: File) -> Iterator[Match]:
    """Verified matches: one for each place of a phrase, the best one of each notice."""
    for t, template in enumerate(index.templates):
        if not index.needed[t] <= file.present:
            continue
        starts = aligned(index, t, file)
        if not template.slack:
            yield from (Match(t, s, 1.0) for s in file.phrase(index.texts[t], starts).tolist())
            continue
        for key in index.keys[t]:
            rare = max(range(len(key)), key=lambda i: index.idf[key[i]])
            there = file.phrase(key, file.places(int(key[rare])) - rare)
            # The key phrase lies within the template's span.
            last = starts + len(index.texts[t]) - len(key) + template.slack
            starts = starts[np.searchsorted(there, last, "right") > np.searchsorted(there, starts - template.slack, "left")]
        if len(starts):
            weights = index.idf[index.texts[t]]
            held = np.stack([near(file.places(w), starts + i, template.slack) for i, w in enumerate(index.texts[t].tolist())], 1)
            shares = (held @ weights) / weights.sum() if weights.sum() > 0 else held.mean(1)
            best = int(np.argmax(shares))
            yield Match(t, int(starts[best]), min(1.0, float(shares[best])))


def scan_text(index: Index, text: str | None) -> tuple[int, list[Match]]:
    """How many words a text has, and its matches."""
    numbers = index.numbers(text)
    return len(numbers), list(matches(index, File(numbers)))


def weighed(docs: DataFrame, text: str = "text", base: tuple[Template, ...] = BASE, more: tuple[Template, ...] = NOTICES) -> Index:
    """The index of the templates with the IDF of their words over all rows of docs; one number a word comes to the driver."""
    index = Index(base, more)

    def run(slices: Iterator[list[list]]) -> Iterator[list[list]]:
        counts, rows = np.zeros(len(index.words), np.int64), 0
        for (texts,) in slices:
            rows += len(texts)
            for t in texts:
                numbers = index.numbers(t)
                counts[np.unique(numbers[numbers >= 0])] += 1
        some = np.nonzero(counts)[0]
        yield [[-1, *some.tolist()], [rows, *counts[some].tolist()]]

    sums = map_slices(spread(docs.select(text)), run, "word int, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    by_word = {r["word"]: r["n"] for r in sums}
    index.weigh(by_word, by_word.get(-1, 0))
    return index


def scan_licenses(docs: DataFrame, index: Index | None = None, text: str = "text", id: str = "doc_id", spans: bool = True) -> DataFrame:
    """For each row of docs its id, n_words, n_base (places of base phrases), first_word and last_word (their smallest and largest start,
    null without any), base_labels, labels (also those of the notices), score (the largest share of a match, 0 of none) and, with spans, matches.

    Null and empty texts have no words and no labels ('' and score 0). Repeated rows and null ids come back as they are; other
    columns are not read. A text of any length is scanned whole, with four bytes for each of its words.
    """
    index = index or weighed(docs, text)
    names = [t.label for t in index.templates]

    def run(slices: Iterator[list[list]]) -> Iterator[list[list]]:
        for ids, texts in slices:
            out = []
            for t in texts:
                n, found = scan_text(index, t)
                base = sorted(m.start for m in found if m.template < index.base)
                labels = {names[m.template] for m in found}
                ends = (base[0], base[-1]) if base else (None, None)
                row = [n, len(base), *ends, ",".join(sorted({names[m.template] for m in found if m.template < index.base})), ",".join(sorted(labels)), max((m.share for m in found), default=0.0)]
                out.append([*row, [{"label": names[m.template], "start": m.start, "share": m.share} for m in found]] if spans else row)
            yield [ids, *map(list, zip(*out, strict=True))]

    kind = docs.schema[id].dataType.simpleString()
    more = ", matches array<struct<label:string,start:long,share:double>>" if spans else ""
    return map_slices(spread(docs.select(id, text)), run, f"`{id}` {kind}, {COLUMNS}{more}")
