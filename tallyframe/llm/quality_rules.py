"""Line-first quality rules.

Every line of a text is judged by punctuation, navigation and boilerplate rules, failing lines are removed,
and a document that loses too much of its text this way is rejected. Whole-text base rules come first.

Words are runs of characters other than U+0020 and U+0009 to U+000D. A null text has no words, no lines
and an empty cleaned text, and fails the base rule on word count, as an empty text does.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame

from .common import map_slices, spread

SYMBOLS = "#*$%&|<>"
WHITE = " \t\n\v\f\r"
#: Marks that a line of prose has somewhere.
SENTENCE_MARKS = ".!?:;…。！？"
#: Signs that set apart the entries of a menu.
NAVIGATION_MARKS = "|»›•"
#: Phrases of page frames in English, French, German and Spanish; each begins and ends with an ASCII letter.
BOILERPLATE = (
    "all rights reserved",
    "click here",
    "cookie policy",
    "enable javascript",
    "lorem ipsum",
    "privacy policy",
    "sign in",
    "skip to content",
    "terms of service",
    "terms of use",
    "aller au contenu",
    "cliquez ici",
    "conditions d'utilisation",
    "mentions légales",
    "politique de cookies",
    "se connecter",
    "tous droits réservés",
    "alle rechte vorbehalten",
    "cookie-richtlinie",
    "datenschutzerklärung",
    "klicken sie hier",
    "nutzungsbedingungen",
    "zum inhalt springen",
    "condiciones de uso",
    "haga clic",
    "iniciar sesión",
    "política de cookies",
    "política de privacidad",
    "saltar al contenido",
    "todos los derechos reservados",
)
#: A line is boilerplate if phrases, as whole words, hold this share of its word characters.
MIN_PHRASE_PERCENT = 20
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: A line fails if over this share of its word characters are symbols.
MAX_SYMBOL_PERCENT = 10
#: Words for each navigation mark, at most, in a line of navigation, which has two marks at least.
NAVIGATION_WORDS = 4
#: A document is rejected if the removed lines hold over this share of its word characters.
MAX_LOST_PERCENT = 50

PHRASES = {p: re.compile(rf"\b{p}\b", re.ASCII) for p in BOILERPLATE}

FIELDS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "n_lines long, n_punctuation_lines long, n_navigation_lines long, n_boilerplate_lines long, lost_chars long, kept boolean"
)


def repeat_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that occur twice or more, the first occurrence included."""
    n = len(words)
    if n < 4:
        return 0
    ids: dict[bytes, int] = {}
    codes = np.array([ids.setdefault(w, len(ids)) for w in words], np.int64)
    k = len(ids)
    pairs = codes[:-1] * k + codes[1:]
    if k >= 1 << 20:
        pairs = np.unique(pairs, return_inverse=True)[1].astype(np.int64)
    windows = pairs[:-1] * k + codes[2:]
    order = np.sort(windows)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return 0
    again = np.isin(windows, twice)
    covered = np.zeros(n, bool)
    covered[:-2] |= again
    covered[1:-1] |= again
    covered[2:] |= again
    return int(covered.sum())


def word_chars(text: str) -> int:
    return len(text) - sum(map(text.count, WHITE))


def line_verdict(line: str) -> str:
    """'' for a line that stays, else the first rule it fails. The line has a word."""
    marks = sum(map(line.count, NAVIGATION_MARKS))
    if marks >= 2 and marks * NAVIGATION_WORDS >= len(line.encode().split()):
        return "navigation"
    symbols = sum(map(line.count, SYMBOLS))
    if symbols and 100 * symbols > MAX_SYMBOL_PERCENT * word_chars(line):
        return "boilerplate"
    low = line.lower()
    found = [p for p in BOILERPLATE if p in low]
    held = sum(word_chars(p) for p in found if PHRASES[p].search(low))
    if held and 100 * held >= MIN_PHRASE_PERCENT * word_chars(line):
        return "boilerplate"
    return "" if any(m in line for m in SENTENCE_MARKS) else "punctuation"


def judge(text: str | None) -> tuple[list, str]:
    """Values for FIELDS, and the text without its failing lines."""
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()
    chars = word_chars(text)
    symbols = sum(map(text.count, SYMBOLS))
    repeats = repeat_words(words)
    base_failed = len(words) < MIN_WORDS or 100 * repeats > MAX_REPEAT_PERCENT * len(words)
    lost, kept_lines, seen, filled = 0, [], set(), 0
    failed = {"punctuation": 0, "navigation": 0, "boilerplate": 0}
    lines = text.split("\n") if text else []
    for line in lines:
        if not line.strip(WHITE):
            kept_lines.append(line)
            continue
        filled += 1
        seen.add(line)
        if verdict := line_verdict(line):
            failed[verdict] += 1
            lost += word_chars(line)
        else:
            kept_lines.append(line)
    kept = not base_failed and 100 * lost <= MAX_LOST_PERCENT * chars
    return [len(words), chars, symbols, filled - len(seen), repeats, base_failed, len(lines), *failed.values(), lost, kept], "\n".join(kept_lines)


def line_first_rules(docs: DataFrame, text: str = "text", id: str = "doc_id", cleaned: bool = True) -> DataFrame:
    """One row for each row of docs: its id, the columns of FIELDS and, if asked for, cleaned_text.

    One narrow pass without a shuffle. Repeated rows and ids are judged each on its own; other columns of
    docs are not read, so their names cannot clash.
    """

    def run(slices: Iterator[list[list]]) -> Iterator[list[list]]:
        for ids, texts in slices:
            judged = [judge(t) for t in texts]
            yield [ids, *map(list, zip(*(x for x, _ in judged), strict=True)), *([[t for _, t in judged]] if cleaned else [])]

    kind = docs.schema[id].dataType.simpleString()
    return map_slices(spread(docs.select(id, text)), run, f"`{id}` {kind}, {FIELDS}" + ", cleaned_text string" * cleaned)
