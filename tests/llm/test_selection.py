"""License scans, importance resampling and hard negatives, against plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyframe.llm import digests, hard_negatives, license_scan, oracles, resampling
from tallyframe.llm.common import word_pieces

NAMES = ("op11_license_scan", "op12_importance_resample", "op13_hard_negatives")
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def plain_words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


@pytest.mark.parametrize("name", NAMES)
def test_matches_sql(spark, sf, name):
    c = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    want = c.sql(oracles.ORACLES[name])
    got = digests.QUERIES[name](spark, sf).select(*want.columns)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want.fetchall(), key=repr) and got.count()


@pytest.mark.parametrize("piece", [1, 7, 1 << 20])
def test_words_of_pieces(piece):
    for text in (None, "", "  ", "One two-three 4é 中文!x\x00y", "a" * 50 + " b", "😀 Z".encode("utf-16", "surrogatepass").decode("utf-16")):
        assert [w.decode() for p in word_pieces(text, piece) for w in p] == plain_words(text)


NOTICES = [
    "Released under the MIT License. And the MIT, license: mit license.",
    "This work is licensed under the GNU General Public License, version 3.",
    "gnu general public. license gnu GENERAL public license",
    "GNU Lesser General Public License",
    "Licensed under the Apache License, Version 2.0 (the License); you may not use this file",
    "apache and then some more words before the license",
    "CC BY-NC 4.0, cc by, CC-BY-SA",
    "Permission is hereby granted, free of charge, to anyone obtaining a copy of this",
    "permission is hereby granted " + "x " * 40 + "free of charge obtaining a copy",
    "Redistribution and use in source and binary forms, with or without modification",
    "license " * 3000 + "mit license " * 2000,
    "nothing to see", "", None,
]


def test_notices(spark):
    docs = spark.createDataFrame(list(enumerate(NOTICES)), "doc_id long, text string")
    rows = {r["doc_id"]: r for r in license_scan.scan_licenses(docs).collect()}
    assert [rows[i]["labels"] for i in range(len(NOTICES))] == ["mit", "gpl,gpl-3.0", "gpl", "lgpl", "apache,apache-2.0", "", "cc-by,cc-by-nc,cc-by-sa", "mit", "", "bsd", "mit", "", "", ""]
    assert rows[6]["base_labels"] == "cc-by" and rows[7]["base_labels"] == "" and 0 < rows[7]["score"] < 1 and rows[0]["score"] == 1
    assert {m["label"] for m in rows[1]["matches"]} == {"gpl", "gpl-3.0"}
    check_base(docs, rows)


def check_base(docs, rows):
    """Base columns by comparing every place with every phrase."""
    for r in docs.select("doc_id", "text").collect():
        words = plain_words(r["text"])
        places = sorted((i, t.label) for t in license_scan.BASE for i in range(len(words)) if words[i : i + len(t.text.split())] == t.text.split())
        got = rows[r["doc_id"]]
        assert (got["n_words"], got["n_base"]) == (len(words), len(places))
        assert (got["first_word"], got["last_word"]) == ((places[0][0], places[-1][0]) if places else (None, None))
        assert got["base_labels"] == ",".join(sorted({label for _, label in places})) and set(filter(None, got["base_labels"].split(","))) <= set(got["labels"].split(","))


def test_licenses_match_sql_on_notices(spark, tmp_path):
    rng = random.Random(6)
    words = sorted({w for t in (*license_scan.BASE, *license_scan.NOTICES) for w in t.text.split()})
    texts = [*NOTICES, *[" ".join(rng.choice([t.text, rng.choice(words), "other"]) for _ in range(12)) for t in license_scan.NOTICES for _ in range(4)]]
    texts += [" ".join(w for w in t.text.split() if rng.random() > 0.1) for t in license_scan.NOTICES for _ in range(6)]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    c = duckdb.connect()
    c.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = c.sql(oracles.ORACLES["op11_license_scan"])
    got = digests.op11_license_scan(spark, str(tmp_path)).select(*want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())


def test_licenses_on_edges(edge, empty, documents):
    rows = license_scan.scan_licenses(edge)
    assert rows.count() == edge.count() and rows.columns[:2] == ["doc_id", "n_words"]
    assert license_scan.scan_licenses(empty).count() == 0
    with_ids = edge.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    for docs in (with_ids, documents):
        check_base(docs, {r["doc_id"]: r for r in license_scan.scan_licenses(docs, spans=False).collect()})
    with pytest.raises(ValueError):
        license_scan.Index((license_scan.Template("x", "some words", ("!",)),))


def plain_resample(rows, target, percent=10, least=20, seed=2024, longest=1):
    def features(text):
        w = plain_words(text)
        return [" ".join(w[i : i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]

    bucket = lambda f: zlib.crc32(f.encode()) % 10000
    s, t = (Counter(bucket(f) for text in texts for f in features(text)) for texts in ([x for _, x in rows], target))
    big_s, big_t = float(sum(s.values())), float(sum(t.values()))
    out = []
    for i, text in rows:
        f = features(text)
        gains = [math.floor(1000 * math.log((t[b] + 1.0) * (big_s + 10000) / ((s[b] + 1.0) * (big_t + 10000)))) for b in map(bucket, f)]
        weight = sum(gains) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(plain_words(text))])
    order = sorted((r for r in out if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    drawn = order[: percent * len(order) // 100]
    left = Counter(tuple(r[:4]) for r in out) - Counter(tuple(r[:4]) for r in drawn)
    return sorted([(*r[:4], k + 1) for k, r in enumerate(drawn)] + [(*r, None) for r in left.elements()], key=repr)


@pytest.mark.parametrize("sizes", [(1 << 17, 1 << 17), (5, 7)])
def test_resample_is_the_plain_one(spark, edge, empty, documents, monkeypatch, sizes):
    """Small runs and ranges go through many merges; repeated rows and null ids take ranks as any other."""
    monkeypatch.setattr(resampling, "RUN_ROWS", sizes[0])
    monkeypatch.setattr(resampling, "RANGE_ROWS", sizes[1])
    target = ["The house of the line goes on", "trees and rivers", None, ""]
    goal = spark.createDataFrame([(t, 1) for t in target], "text string, score int")
    many = documents.select("doc_id", "text").unionByName(documents.limit(40).select("doc_id", "text")).unionByName(edge.select("doc_id", "text"))
    many = many.unionByName(spark.range(60).select(F.lit(7).cast("long").alias("doc_id"), F.lit("the same words again and again " * 5).alias("text"))).unionByName(spark.range(9).select(F.lit(None).cast("long").alias("doc_id"), F.lit("no id at all here " * 9).alias("text")))
    for docs, percent, longest in ((many.repartition(5), 10, 1), (many, 50, 2), (many, 100, 1), (edge, 40, 1), (documents, 3, 3)):
        got = resampling.resample(docs, goal, percent=percent, longest=longest)
        assert [kind for _, kind in got.dtypes] == ["bigint"] * 5
        rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
        assert sorted(map(tuple, got.collect()), key=repr) == plain_resample(rows, target, percent=percent, longest=longest)
    assert resampling.resample(empty, goal).count() == 0
    assert resampling.resample(documents, empty).where("rank IS NOT NULL").count() == resampling.resample(documents, goal).where("rank IS NOT NULL").count() > 0
    assert resampling.resample(documents, goal, percent=0).where("rank IS NOT NULL").count() == 0


def test_tournament():
    rng = random.Random(1)
    for k in (0, 1, 2, 3, 7, 16, 33):
        runs = [sorted((rng.randint(0, 20),) for _ in range(rng.randint(0, 9))) for _ in range(k)]
        tree, out = resampling.Tournament(runs), []
        while at := tree.pop():
            out.append(runs[at[0]][at[1]])
        assert out == sorted(x for r in runs for x in r)


def plain_mining(rows):
    """rows: (id, vector, label), as the contract has it; equal anchors once."""
    fine = [(i, [math.floor(256 * float(x)) for x in v], g) for i, v, g in rows if i is not None and g is not None and v is not None and len(v) == 8 and all(x is not None and math.isfinite(x) for x in v)]
    score = lambda a, b: sum(x * y for x, y in zip(a, b, strict=True))
    out, seen = [], set()
    for at, (i, v, g) in enumerate(fine):
        if i % 10 or (i, tuple(v), g) in seen:
            continue
        seen.add((i, tuple(v), g))
        others = sorted((-score(v, w), j, h) for b, (j, w, h) in enumerate(fine) if b != at)
        for minus, p, _ in [x for x in others if x[2] == g][:5]:
            inside = [x for x in others if x[2] != g and 80 * -minus <= 100 * -x[0] <= 100 * -minus][:5]
            out += [(i, p, k + 1, n, -minus, -s) for k, (s, n, _) in enumerate(inside)]
    return sorted(out)


@pytest.mark.parametrize("tile", [8192, 64])
def test_mining_is_the_plain_one(spark, monkeypatch, tile):
    monkeypatch.setattr(hard_negatives, "TILE_ROWS", tile)
    rng = np.random.default_rng(tile)
    centres = rng.normal(size=(6, 8))
    rows = [(i, (centres[rng.integers(6)] + rng.normal(size=8) * 0.4).tolist(), int(rng.integers(4))) for i in range(400)]
    rows += [(1000 + i, centres[0].tolist(), i % 3) for i in range(90)]  # one vector very often
    rows += [rows[0], rows[0], rows[10], (10, rows[11][1], rows[10][2]), (2000, [0.0] * 8, 1), (2010, [1e-9] * 8, 2), (-20, rows[3][1], 0), (3000, [1e9] * 8, 1), (3010, [-3e9] * 8, 1), (3020, [2e9] * 8, 2)]
    rows += [(None, rows[1][1], 1), (5000, None, 1), (5010, rows[2][1], None), (5020, [float("nan")] * 8, 1), (5030, [float("inf"), *[0.0] * 7], 1), (5040, [None, *[0.0] * 7], 1), (5050, [1.0, 2.0], 1), (5060, [], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("h", F.lit(1)).withColumn("place", F.lit("x")).repartition(5)
    got = hard_negatives.mine(df, F.col("vec") % 10 == 0)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, got.collect())) == plain_mining(rows) != []
    assert hard_negatives.mine(df.limit(0), F.col("vec") % 10 == 0).count() == 0
    assert hard_negatives.mine(df.where("label = 1"), F.col("vec") % 10 == 0).count() == 0
    assert hard_negatives.mine(df, F.col("vec") < -100).count() == 0


def test_bounds_hold():
    """Looked-up scores lie within their bounds of the true ones, and prune."""
    rng = np.random.default_rng(9)
    x = np.floor(256 * rng.normal(size=(3000, 16)) / 4)
    q = hard_negatives.Quantizer(x[:1000])
    codes, residuals = q.encode(x)
    scores, bounds = q.scores(x[:50], codes, residuals)
    true = x[:50] @ x.T
    assert (np.abs(scores - true) <= bounds).all() and codes.dtype == np.uint8
    assert np.median(bounds) < 0.25 * np.median(np.linalg.norm(x, axis=1)) ** 2
