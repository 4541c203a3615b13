"""Quality classifier: a sparse ensemble of rules.

Trees are grown on statistics of labelled texts, each with its own draw of rows and statistics. Every path from a
root to a node is a rule, a conjunction of comparisons. A logistic model with an L1 penalty weighs the rules, which
leaves few of them, and those are compiled into one Spark column expression over the statistics.

The fit sees a bounded sample of labelled rows, as numbers only; texts never leave the executors.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import crc_bucket, map_slices, smallest_by_hash, spread, with_columns_of

#: Rows of each class that one tree is grown on, at most.
TREE_ROWS = 1500
#: Labelled rows that a model is fitted to, at most: those with the smallest hashes of their ids.
TRAIN_ROWS = 20_000
TREES = 24
DEPTH = 3
#: Statistics a node may split on, and thresholds tried for each.
TRIED = 6
THRESHOLDS = 24
LEAF_ROWS = 12
L1 = 0.002
STEPS = 600
THRESHOLD = 0.3
#: Distinct words are counted in windows of this many, so that long texts compare with short ones.
WINDOW_WORDS = 100
#: Digits that thresholds and statistics keep, so that they compare alike in Python and in Spark.
DIGITS = 6

STATISTICS = (
    "log_words",
    "mean_word",
    "symbol_share",
    "upper_share",
    "digit_share",
    "mark_share",
    "exclaim_share",
    "bar_share",
    "unique_share",
    "top_word_share",
    "upper_word_share",
    "line_words",
    "repeat_line_share",
    "letterless_share",
)


def statistics(text: str | None) -> list[float]:
    """Values for STATISTICS; all zero for a null or empty text."""
    text = text or ""
    words = text.split()
    if not words:
        return [0.0] * len(STATISTICS)
    n, chars = len(words), sum(map(len, words))
    counts = Counter(words)
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    by = np.bincount(data, minlength=256)
    lines = [x for x in text.split("\n") if x.strip()]
    values = (
        math.log1p(n),
        chars / n,
        sum(int(by[ord(c)]) for c in "#*$%&|<>~^_=+@\\{}") / chars,
        int(by[65:91].sum()) / chars,
        int(by[48:58].sum()) / chars,
        sum(int(by[ord(c)]) for c in ".,;:") / n,
        int(by[33] + by[63]) / n,
        int(by[124]) / n,
        sum(len(set(words[i : i + WINDOW_WORDS])) for i in range(0, n, WINDOW_WORDS)) / n,
        max(counts.values()) / n,
        sum(len(w) > 1 and w.isupper() for w in words) / n,
        math.log1p(n / max(1, len(lines))),
        1 - len(set(lines)) / max(1, len(lines)),
        sum(not any(map(str.isalpha, w)) for w in counts) / len(counts),
    )
    return [round(v, DIGITS) for v in values]


def text_statistics(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """The columns `keep` of docs, and STATISTICS. Narrow; repeated rows stay."""
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)

    def run(slices: Iterator[list[list]]) -> Iterator[list[list]]:
        for *kept, texts in slices:
            yield [*kept, *map(list, zip(*map(statistics, texts), strict=True))]

    return map_slices(spread(docs.select(*keep, text)), run, f"{kinds}, " + ", ".join(f"{s} double" for s in STATISTICS))


@dataclass(frozen=True)
class Rule:
    """A conjunction of (statistic, above, threshold): value > threshold, or else <=."""

    terms: tuple[tuple[int, bool, float], ...]

    def holds(self, x: np.ndarray) -> np.ndarray:
        ok = np.ones(len(x), bool)
        for f, above, at in self.terms:
            ok &= (x[:, f] > at) == above
        return ok

    def column(self) -> Column:
        out = F.lit(True)
        for f, above, at in self.terms:
            c = F.col(STATISTICS[f])
            out = out & (c > at if above else c <= at)
        return out


@dataclass(frozen=True)
class RuleModel:
    intercept: float
    rules: tuple[tuple[Rule, float], ...]

    def margin(self) -> Column:
        """The log-odds as one column expression over STATISTICS."""
        out = F.lit(self.intercept)
        for rule, weight in self.rules:
            out = out + F.when(rule.column(), weight).otherwise(0.0)
        return out

    def score(self) -> Column:
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-self.margin()))

    def scores(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.intercept)
        for rule, weight in self.rules:
            z += weight * rule.holds(x)
        return 1 / (1 + np.exp(-z))


def grow(x: np.ndarray, y: np.ndarray, rng: np.random.Generator, depth: int, terms: tuple, out: set[Rule]) -> None:
    """Add the rules of a tree on (x, y): one for each node below the root."""
    if depth == 0 or len(y) < 2 * LEAF_ROWS or y.min() == y.max():
        return
    best = (1e-6, -1, 0.0)
    whole = y.mean() * (1 - y.mean())
    for f in sorted(rng.choice(x.shape[1], min(TRIED, x.shape[1]), replace=False).tolist()):
        values = np.sort(x[:, f])
        for at in np.unique(values[np.linspace(0, len(values) - 1, THRESHOLDS + 2).astype(int)[1:-1]]):
            low = x[:, f] <= at
            a = int(low.sum())
            if LEAF_ROWS <= a <= len(y) - LEAF_ROWS:
                p, q = y[low].mean(), y[~low].mean()
                gain = whole - (a * p * (1 - p) + (len(y) - a) * q * (1 - q)) / len(y)
                if gain > best[0]:
                    best = (gain, f, float(at))
    _, f, at = best
    if f < 0:
        return
    for above in (False, True):
        side = (x[:, f] > at) == above
        path = (*terms, (f, above, at))
        out.add(Rule(path))
        grow(x[side], y[side], rng, depth - 1, path, out)


def lasso_logistic(a: np.ndarray, y: np.ndarray, l1: float = L1, steps: int = STEPS) -> tuple[float, np.ndarray]:
    """Intercept and weights that minimise mean log-loss plus l1 times the weights' absolute sum, by accelerated proximal steps."""
    n, m = a.shape
    w, b = np.zeros(m), float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    step = 4 / max(1e-9, np.linalg.norm(np.column_stack([np.ones(n), a]), 2) ** 2 / n)
    v, c, momentum = w, b, 1.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-(a @ v + c)))
        g = (p - y) / n
        moved = v - step * (a.T @ g)
        new_w = np.sign(moved) * np.maximum(np.abs(moved) - step * l1, 0)
        new_b = c - step * g.sum()
        later = (1 + math.sqrt(1 + 4 * momentum**2)) / 2
        v = new_w + (momentum - 1) / later * (new_w - w)
        c = new_b + (momentum - 1) / later * (new_b - b)
        w, b, momentum = new_w, new_b, later
    return b, w


def fit(x: np.ndarray, y: np.ndarray, seed: int = 10, tree_rows: int = TREE_ROWS) -> RuleModel:
    """A model from statistics x and labels y; a constant 0.5 without labels, a constant near y if all are alike.

    Each tree is grown on a draw with replacement of as many rows of either class as the smaller one has, but 50 at least and tree_rows at most;
    the weights of the rules are fitted to all rows.
    """
    if not len(y):
        return RuleModel(0.0, ())
    order = np.lexsort([*x.T, y])
    x, y = x[order], y[order].astype(float)
    if y.min() == y.max():
        return RuleModel(4.0 if y[0] else -4.0, ())
    rng = np.random.default_rng(seed)
    # Both classes get the same weight in the draws, or trees would hardly see the rarer one.
    good, bad = np.nonzero(y == 1)[0], np.nonzero(y == 0)[0]
    half = min(tree_rows, max(50, min(len(good), len(bad))))
    rules: set[Rule] = set()
    for _ in range(TREES):
        rows = np.concatenate([rng.choice(good, half), rng.choice(bad, half)])
        grow(x[rows], y[rows], rng, DEPTH, (), rules)
    # Rules that hold for the same rows are one.
    distinct: dict[bytes, Rule] = {}
    for rule in sorted(rules, key=lambda r: (len(r.terms), r.terms)):
        distinct.setdefault(rule.holds(x).tobytes(), rule)
    rules_in = list(distinct.values())
    if not rules_in:
        return RuleModel(float(np.log(y.mean() / (1 - y.mean()))), ())
    a = np.column_stack([r.holds(x) for r in rules_in]).astype(float)
    intercept, weights = lasso_logistic(a, y)
    return RuleModel(float(intercept), tuple((r, float(w)) for r, w in zip(rules_in, weights, strict=True) if abs(w) > 1e-6))


def held_out(id: str = "doc_id") -> Column:
    """Rows whose labels no model may learn from; a row without an id is never learned from."""
    return F.coalesce(crc_bucket(id, 5) == 0, F.lit(True))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", text: str = "text", id: str = "doc_id", rows: int = TRAIN_ROWS, tree_rows: int = TREE_ROWS) -> RuleModel:
    """A model from at most `rows` labelled ids that are not held out, each tree from at most tree_rows of each class. Labels are 0 or 1; other rows of labels are left aside."""
    usable = labels.where(F.col(label).isin(0, 1) & ~held_out(id)).select(F.col(id), F.col(label).cast("int").alias("y"))
    chosen = smallest_by_hash(usable, id, rows, seed=10)
    # An id that is labelled twice counts with the lower label.
    marked = usable.join(F.broadcast(chosen), id, "left_semi").groupBy(id).agg(F.min("y").alias("y"))
    # An id with several texts counts once, with the smallest statistics, so that the rows that come to the driver are bounded.
    each = text_statistics(with_columns_of(docs, ["y"]).join(F.broadcast(marked), id), [id, "y"], text)
    found = each.groupBy(id).agg(F.min(F.struct("y", *STATISTICS)).alias("x")).select("x.*").toPandas()
    return fit(found[list(STATISTICS)].to_numpy(float).reshape(-1, len(STATISTICS)), found["y"].to_numpy(int), tree_rows=tree_rows)


def classify(docs: DataFrame, model: RuleModel, text: str = "text", id: str = "doc_id", threshold: float = THRESHOLD, outputs: bool = True) -> DataFrame:
    """One row for each row of docs: its id, score, predicted and, if asked for, STATISTICS.

    Null and empty texts have all statistics zero and a score like any other text. Only id and text are read.
    """
    scored = text_statistics(docs, [id], text).withColumn("score", model.score())
    return scored.select(id, "score", (F.col("score") >= threshold).cast("int").alias("predicted"), *(STATISTICS if outputs else ()))


def keep_good(docs: DataFrame, labels: DataFrame, text: str = "text", id: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs that are predicted good by a model trained on those of them that have labels."""
    model = train(docs, labels, text=text, id=id)
    names = [f"c{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*names)
    at = names[[c.lower() for c in docs.columns].index(text.lower())]
    doubled = plain.withColumn("__text", F.col(at))
    kept = text_statistics(doubled, names, "__text").where(model.score() >= threshold)
    return kept.select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns, strict=True)])
