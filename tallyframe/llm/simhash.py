"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Each distinct fingerprint emits all fingerprints within half the radius. Two fingerprints within the radius share
one of these variants, so after a shuffle on variants, neighbours that meet there are linked if their distance
is verified to lie within the radius.

Documents with the same fingerprint are folded into one before any variant is made, and fingerprints that meet on
a variant are chained in order instead of paired: with radius 2 all of them lie within it of each other.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut_lineage, map_slices, release, spread

SEED = 42
#: Shingles whose bits are counted at once.
CHUNK = 1 << 16
#: Rows to drop, of three numbers each, that are broadcast at most; more of them are joined by a shuffle.
BROADCAST_ROWS = 200_000
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def fingerprint(text: str | None, words: int = 3) -> int:
    """Bits set in over half the XXH64 hashes of the text's word shingles, repeats included; 0 without words."""
    tokens = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(tokens) > words:
        starts, ends = starts[: 1 - words], ends[words - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    h = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for at in range(0, len(starts), CHUNK):
        hashes = np.array([h(joined[a:b], SEED) for a, b in zip(starts[at : at + CHUNK].tolist(), ends[at : at + CHUNK].tolist(), strict=True)], "<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = 2 * counts > len(starts)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), words: int = 3) -> DataFrame:
    """The columns `keep` and fp (the fingerprint as a signed 64-bit integer) for each row of docs. Narrow; reads nothing else but text."""

    def run(slices: Iterator[list[list]]) -> Iterator[list[list]]:
        for *kept, texts in slices:
            yield [*kept, np.array([fingerprint(t, words) for t in texts], np.uint64).view(np.int64)]

    kinds = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in keep)
    return map_slices(spread(docs.select(*keep, text)), run, f"{kinds}fp long")


def ball_links(fps: DataFrame, radius: int = 2) -> DataFrame:
    """Links (a, b) that connect the same fingerprints as all pairs within the radius. fps: distinct column fp.

    The radius is 1 or 2: each fingerprint then emits itself and its 64 one-bit neighbours.
    """
    if radius not in (1, 2):
        raise ValueError("radius must be 1 or 2")
    masks = F.array(*[F.lit(m) for m in [0, *[(1 << b) - (1 << 64) * (b == 63) for b in range(64)]]])
    variants = fps.select("fp", F.explode(masks).alias("mask")).select(F.col("fp").bitwiseXOR(F.col("mask")).alias("variant"), "fp")
    met = variants.withColumn("before", F.lag("fp").over(Window.partitionBy("variant").orderBy("fp")))
    return met.where(F.col("before").isNotNull() & (F.bit_count(F.col("before").bitwiseXOR(F.col("fp"))) <= radius)).select(F.col("before").alias("a"), F.col("fp").alias("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for each node of links (a, b): nodes have the same root if and only if links connect them.

    Each round sends every node to that neighbour (or itself) which comes first in a fresh random order, and
    carries links over to those; components stay connected and shrink by a constant factor, whatever their
    shape. Tables are cut at the shared checkpoint folder between rounds; only their sizes come to the driver.
    """
    links = held = cut_lineage(links.where("a <> b"))
    rounds: list[DataFrame] = []
    while not links.isEmpty():
        seed = F.lit(len(rounds))
        both = links.select(F.col("a").alias("node"), F.col("b").alias("near")).unionAll(links.select("b", "a"))
        order = F.xxhash64(seed, "near")
        best = both.groupBy("node").agg(F.min(F.struct(order.alias("o"), F.col("near").alias("n"))).alias("m"))
        own = F.struct(F.xxhash64(seed, "node").alias("o"), F.col("node").alias("n"))
        moves = cut_lineage(best.select("node", F.least(F.col("m"), own)["n"].alias("to")))
        rounds.append(moves)
        a = links.join(moves.select(F.col("node").alias("a"), F.col("to").alias("ta")), "a")
        ends = a.join(moves.select(F.col("node").alias("b"), F.col("to").alias("tb")), "b")
        links = cut_lineage(ends.where("ta <> tb").select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b")).distinct())
        release(held)
        held = links
    if not rounds:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = reduce(lambda done, later: done.join(later.select(F.col("node").alias("root"), F.col("to").alias("next")), "root", "left").select("node", F.coalesce("next", "root").alias("root")), rounds[1:], rounds[0].withColumnRenamed("to", "root"))
    roots = cut_lineage(roots)
    release(held, *rounds)
    return roots


def group_roots(marked: DataFrame, radius: int) -> DataFrame:
    """(fp, root) of those fingerprints of marked that are linked to others: linked ones have the same root."""
    distinct = cut_lineage(marked.select("fp").distinct())
    roots = components(ball_links(distinct, radius)).withColumnRenamed("node", "fp")
    release(distinct)
    return roots


def near_duplicates(docs: DataFrame, text: str = "text", id: str = "doc_id", words: int = 3, radius: int = 2) -> DataFrame:
    """One row for each row of docs: its id, fingerprint (hexadecimal) and component_id, the smallest id it reaches.

    Null and empty texts have fingerprint zero and are linked as any other. A null id never names a component,
    unless it has no other member (component_id is then null).
    """
    marked = cut_lineage(fingerprints(docs, text, (id,), words))
    folded = cut_lineage(marked.groupBy("fp").agg(F.min(id).alias("least")))
    roots = group_roots(marked, radius)
    linked = roots.join(folded, "fp").select("fp", "root", "least")
    groups = cut_lineage(linked.groupBy("root").agg(F.min("least").alias("group_least")))
    named = linked.join(groups, "root").select("fp", "group_least")
    least = cut_lineage(folded.join(named, "fp", "left").select("fp", F.coalesce("group_least", "least").alias("component_id")))
    release(folded, roots, groups)
    return marked.join(least, "fp").select(id, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, text: str = "text", id: str = "doc_id", words: int = 3, radius: int = 2) -> DataFrame:
    """docs with one row of each group of near-duplicates: the one with the smallest id, ids before nulls, then that with the smallest hash.

    A row is told by its id, a hash of its text and one of all its columns, so that neither repeated nor null ids lose a text, and
    the choice depends on the rows alone. Rows alike in all columns are copies of which one stays; map columns do not count, so that rows
    that differ in nothing else are copies too. Only hashes are
    shuffled; texts move where the rows to drop are too many for a broadcast, or to fold rows alike in all columns.
    """
    names = [f"c{i}" for i in range(len(docs.columns))]
    at = {c.lower(): n for c, n in zip(docs.columns, names, strict=True)}
    hashed = [f"`{n}`" for n, (_, kind) in zip(names, docs.dtypes, strict=True) if not kind.startswith("map")]
    keyed = docs.toDF(*names).select("*", F.col(at[id.lower()]).alias("k"), F.xxhash64(at[text.lower()]).alias("h"), F.xxhash64(*hashed).alias("r"))
    key = ["k", "h", "r"]
    marked = cut_lineage(fingerprints(keyed, at[text.lower()], tuple(key), words).groupBy(*key, "fp").agg(F.count("*").alias("copies")))
    roots = group_roots(marked, radius)
    rows = marked.join(roots, "fp", "left").select(*key, "copies", F.coalesce("root", "fp").alias("root"))
    first = cut_lineage(rows.groupBy("root").agg(F.min(F.struct(F.col("k").isNull().alias("none"), *key)).alias("first")))
    stays = F.col("first.k").eqNullSafe(F.col("k")) & (F.col("first.h") == F.col("h")) & (F.col("first.r") == F.col("r"))
    marks = cut_lineage(rows.join(first, "root").select(*key, "copies", stays.alias("stays")).where("NOT stays OR copies > 1"))
    release(marked, roots, first)

    def told(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
        right = right.select(*[F.col(c).alias(f"m{c}") for c in key])
        right = F.broadcast(right) if right.count() <= BROADCAST_ROWS else right
        return left.join(right, left["k"].eqNullSafe(right["mk"]) & (left["h"] == right["mh"]) & (left["r"] == right["mr"]), how)

    kept = told(keyed, marks, "left_anti")
    folded = marks.where("stays")
    if not folded.isEmpty():
        kept = kept.unionByName(told(keyed, folded, "left_semi").dropDuplicates(key))
    return kept.select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns, strict=True)])
