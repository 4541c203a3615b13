"""Shards, duplicates, neighbours, hosts, language models, the classifier and the pipeline, against plain versions."""

import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from tallyframe.llm import ann, digests, lm_score, oracles, packing, rule_ensemble, sharding, simhash, url_filter

from .conftest import edge_rows


def test_hilbert_curve_steps_by_one():
    for dims, bits in ((2, 3), (3, 2), (2, 5)):
        cells = np.array(np.meshgrid(*[range(1 << bits)] * dims)).reshape(dims, -1).T
        index = sharding.hilbert_index(cells, bits)
        assert sorted(index.tolist()) == list(range(1 << (dims * bits)))
        path = cells[np.argsort(index)]
        assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def check_shards(docs, shards):
    rows = sharding.assign_shards(docs, shards).collect()
    want = Counter((r["doc_id"], len((r["text"] or "").encode()) + 16, zlib.crc32((r["text"] or "").encode())) for r in docs.select("doc_id", "text").collect())
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want
    by = defaultdict(list)
    for r in rows:
        by[r["shard"]].append(r["slot"])
        assert r["law"] == "rows" and r["grown_shard"] is None and 0 <= r["shard"] < shards
    counts = [len(by[s]) for s in range(shards)]
    assert not counts or max(counts) - min(counts) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    # Shards are runs of the curve, and copies of a text stand together on it.
    order = sorted(rows, key=lambda r: (r["shard"], r["slot"]))
    assert [r["curve"] for r in order] == sorted(r["curve"] for r in order)
    texts = [(r["text_crc32"], r["size"]) for r in order]
    assert sum(a != b for a, b in zip(texts, texts[1:], strict=False)) + 1 == len(set(texts)) or not rows
    return rows


def test_curve_is_the_cells_index(spark, documents):
    """curve is the Hilbert index of the cells of a row's size, language and source, those of its first document for a copy."""
    cells = lambda d: [sharding.log_cell(F.octet_length(F.coalesce("text", F.lit(""))) + sharding.ROW_BYTES), *[sharding.hash_cell(F.col(c)) for c in d]]
    plain = documents.select("doc_id", "text", *[c.cast("int").alias(f"c{i}") for i, c in enumerate(cells(("lang", "source")))]).collect()
    first = {}
    for r in sorted(plain, key=lambda r: r["doc_id"]):
        first.setdefault(r["text"] or "", r)
    want = {r["doc_id"]: int(sharding.hilbert_index(np.array([[r["c0"], first[r["text"] or ""]["c1"], first[r["text"] or ""]["c2"]]]), sharding.BITS)[0]) for r in plain}
    assert {r["doc_id"]: r["curve"] for r in sharding.assign_shards(documents).collect()} == want


def test_shards(edge, empty, documents):
    check_shards(edge, 5)
    check_shards(edge, 40)
    assert not check_shards(empty, 40)
    rows = check_shards(documents, 40)
    parted = defaultdict(set)
    for r in rows:
        parted[r["text_crc32"]].add(r["shard"])
    assert sum(len(s) > 1 for s in parted.values()) < 40
    assert sharding.assign_shards(documents.select("doc_id", "text"), 40).count() == documents.count()


def test_shard_files(spark, documents, tmp_path):
    sharding.write_shards(documents.withColumn("slot", F.lit(1)), sharding.assign_shards(documents, 8), str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == documents.count() and back.select("shard").distinct().count() == 8


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(ids, fps, radius=2):
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                root[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return [least.get(find(i)) for i in range(len(ids))]


@pytest.mark.parametrize("which", ["edge", "documents"])
def test_near_duplicates(request, which):
    docs = request.getfixturevalue(which)
    rows = docs.select("doc_id", "text").collect()
    fps = [plain_fingerprint(r["text"]) for r in rows]
    want = Counter((r["doc_id"], f"{f:016x}", g) for r, f, g in zip(rows, fps, plain_groups([r["doc_id"] for r in rows], fps), strict=True))
    assert Counter(map(tuple, simhash.near_duplicates(docs).collect())) == want


def test_ball_links_and_components(spark, empty):
    rng = np.random.default_rng(8)
    centres = rng.integers(-(2**63), 2**63, 6)
    fps = {int(c) for c in centres}
    for c in centres.tolist():
        at = c
        for _ in range(12):
            for b in rng.choice(64, 2, replace=False).tolist():
                at ^= (1 << b) - (1 << 64) * (b == 63)
            fps.add(at)
    fps = sorted(fps)
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    roots = {r["node"]: r["root"] for r in simhash.components(simhash.ball_links(df)).collect()}
    groups = plain_groups(list(range(len(fps))), [f & (2**64 - 1) for f in fps])
    mine, want = defaultdict(set), defaultdict(set)
    for i, f in enumerate(fps):
        mine[roots.get(f, f)].add(f)
        want[groups[i]].add(f)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, want.values()))
    path = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert simhash.components(path).select("root").distinct().count() == 1
    assert simhash.near_duplicates(empty).count() == 0


def plain_keep_one(rows, text=1):
    """The rows that stay: of each group the one with the smallest (null last, id); of several such, any, so a set of texts and a count."""
    groups = plain_groups(list(range(len(rows))), [plain_fingerprint(r[text]) for r in rows])
    out = {}
    for r, g in zip(rows, groups, strict=True):
        out.setdefault(g, []).append(r)
    return [(min((x[0] is None, x[0] or 0) for x in members), members) for members in out.values()]


def check_keep_one(docs):
    rows = list(map(tuple, docs.collect()))
    kept = list(map(tuple, simhash.keep_one(docs).collect()))
    groups = plain_keep_one(rows, docs.columns.index("text"))
    assert len(kept) == len(groups)
    for (none, least), members in groups:
        own = [r for r in kept if r in members]
        assert len(own) == 1 and (own[0][0] is None, own[0][0] or 0) == (none, least)
    assert sorted(map(tuple, simhash.keep_one(docs.repartition(5)).collect()), key=repr) == sorted(kept, key=repr)


@pytest.mark.parametrize("most", [200_000, 0])
def test_keep_one(spark, edge, empty, documents, monkeypatch, most):
    monkeypatch.setattr(simhash, "BROADCAST_ROWS", most)
    assert simhash.keep_one(edge).columns == edge.columns and simhash.keep_one(empty).count() == 0
    check_keep_one(edge)
    words = [" ".join(f"{w}{i}" for i in range(60)) for w in "abcdef"]
    # Ids that clash on unlike texts, null ids, copies alike in all columns and copies unlike in another one.
    rows = [(5, words[0], "x"), (5, words[1], "x"), (3, words[1], "x"), (5, words[2], "y"), (5, words[2], "y"), (5, words[2], "z"), (None, words[3], "x"), (None, words[3], "x"), (None, words[3], None), (None, words[4], "x"), (8, words[4], "x"), (None, None, None), (9, "", "k")]
    check_keep_one(spark.createDataFrame(rows, "doc_id long, text string, h string"))
    check_keep_one(documents)


def plain_nearest(rows, k=5):
    """Query id: [(-score, id)] of all rows but the query's own."""
    out = {}
    x = np.array([v for _, v in rows], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    for i, (q, _) in enumerate(rows):
        if q % 50 == 0:
            s = x @ x[i]
            out[q] = sorted(((round(-s[j], 12), rows[j][0]) for j in range(len(rows)) if j != i))[:k]
    return out


def found_nearest(df, **how):
    got = defaultdict(list)
    for r in ann.nearest(df, F.col("vec") % 50 == 0, **how).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((round(-r["score"], 12), r["vec_id"]))
        assert r["rank"] == len(got[r["query_id"]])
    return got


def test_neighbours_exact_and_edges(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(120)]
    rows += [(200 + i, rows[50][1]) for i in range(9)] + [(300, [2 * v for v in rows[50][1]])]
    odd = [(400, None), (401, [0.0] * 4), (402, [1.0, None, 0.0, 0.0]), (403, [float("nan"), 1.0, 1.0, 1.0]), (404, [float("inf"), 1.0, 1.0, 1.0]), (405, [1.0]), (None, [1.0] * 4), (450, [])]
    # Repeated rows: each is a candidate, and alike query rows are one query.
    rows += [rows[7], rows[7], rows[50]]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").withColumn("v", F.lit(1)).withColumn("rank", F.lit(2))
    got, want = found_nearest(df, target=1.0), plain_nearest(rows)
    assert got.keys() == want.keys()
    for q in want:
        assert [s for s, _ in got[q]] == pytest.approx([s for s, _ in want[q]], abs=1e-9)
        assert [v for _, v in got[q]] == [v for _, v in want[q]]
    assert [v for _, v in got[50]][0] == 50
    few = spark.createDataFrame(rows[:3], "vec_id long, embedding array<double>")
    assert ann.nearest(few, F.col("vec") % 50 == 0).count() == 2
    assert ann.nearest(few.limit(0), F.col("vec") % 50 == 0).count() == 0


@pytest.mark.parametrize("n", [500, 3000])
def test_neighbours_recall(spark, n):
    """Tables of any size take the same path; the forest has leaves to choose from in both."""
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=16).tolist()) for i in range(n)]
    got = found_nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    want = plain_nearest(rows)
    assert sum(len({v for _, v in got[q]} & {v for _, v in w}) for q, w in want.items()) >= 0.9 * 5 * len(want)


def test_parallel_vectors(spark):
    """Rows of equal score are cut by id inside the search; same ids on unlike vectors are unlike rows."""
    v = np.random.default_rng(3).normal(size=8)
    tile = np.arange(1, 10_001)[:, None] * v
    ids = np.arange(10_000)
    q, fold, rep, s = ann.search_tile(v[None].repeat(3, 0), np.array([7, 8, 9]), np.array([1, 3, 2]), tile, ids + 50, ids, ids % 2, 6)
    assert Counter(q.tolist()) == {7: 6, 8: 6, 9: 6} and s == pytest.approx(1) and (fold == rep + 50).all()
    exact = ann.cosines(v[None].repeat(10_000, 0), tile)
    order = sorted(range(10_000), key=lambda i: (-exact[i], i))
    assert [rep[q == 8].tolist(), rep[q == 7].tolist(), rep[q == 9].tolist()] == [order[:6], [i for i in order if i % 2 == 0][:6], [i for i in order if i % 2][:6]]
    rows = [(i, (2.0 ** (i % 30) * v).tolist()) for i in range(400)] + [(50, (-v).tolist()), (50, (-2 * v).tolist())]
    got = defaultdict(list)
    for r in ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec") == 100).orderBy("rank").collect():
        got[r["query_id"]].append(r["vec_id"])
    assert got == {100: [0, 1, 2, 3, 4]}


def test_forest_search_reaches_every_leaf():
    x = ann.unit(np.random.default_rng(1).normal(size=(200, 8)))
    forest = ann.Forest(x, 3)
    assert len(set(forest.walk(x[0]))) == 4 * 8
    leaves = forest.leaves(x)
    first = {}
    for t, leaf in forest.walk(x[7]):
        first.setdefault(t, leaf)
    assert [first[t] for t in range(4)] == leaves[7].tolist()


def test_url_parts(spark):
    urls = {"HTTP://A.Example.COM/en/7?x#y": ("a.example.com", "/en/7"), "x://h#/en/": ("h", ""), "no scheme": ("", ""), "a://b://c/d": ("b:", "//c/d"), "s://": ("", ""), "s://h?q": ("h", ""), "s://h/\nx": ("h", "/\nx"), None: ("", ""), "": ("", "")}
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = df.select("url", url_filter.host_of(F.col("url")).alias("h"), url_filter.path_of(F.col("url")).alias("p")).collect()
    assert {r["url"]: (r["h"], r["p"]) for r in got} == urls


def test_suffixes_of_two_labels(spark):
    hosts = {"www.a.co.uk": ("a.co.uk", "co.uk"), "a.co.uk": ("a.co.uk", "co.uk"), "co.uk": ("co.uk", "co.uk"), "m.b.com.au": ("b.com.au", "com.au"), "x.a.uk": ("a.uk", "uk"), "a.b.com": ("b.com", "com"), "h": ("h", "h"), "": ("", "")}
    hosts |= {"a.b.com:8080": ("b.com", "com"), "user@x.b.co.uk:1": ("b.co.uk", "co.uk"), "192.168.0.1": ("192.168.0.1", "[address]"), "10.0.0.2:81": ("10.0.0.2", "[address]"), "[::1]:80": ("[::1]", "[address]"), "1.2.3": ("2.3", "3")}
    got = spark.createDataFrame([(h,) for h in hosts], "host string").select("host", url_filter.domain_of(F.col("host")).alias("d"), url_filter.suffix_of(F.col("host")).alias("s")).collect()
    assert {r["host"]: (r["d"], r["s"]) for r in got} == hosts


def test_url_rules_and_reputation(spark):
    pages = [(1, "x://a.com/en/1"), (2, "x://www.example.com/en/77"), (3, "x://a.net/de/8"), (4, "x://example.net/de/8"), (5, "x://xcom/en/"), (6, "x://b.org/es"), (7, None)]
    pages += [(100 + i, f"x://bad.info/{i}") for i in range(80)] + [(300 + i, f"x://good.info/{i}") for i in range(80)] + [(500, "x://one.info/"), (501, "x://new.info/"), (501, "x://new.info/")]
    outcomes = [(100 + i, 1) for i in range(60)] + [(300 + i, 0) for i in range(60)] + [(500, 1), (None, 1), (101, None), (102, 7)]
    df = spark.createDataFrame(pages, "page_id long, url string").withColumn("host", F.lit("clash")).withColumn("bad", F.lit("clash"))
    rows = url_filter.judge_urls(df, spark.createDataFrame(outcomes, "page_id long, bad int")).collect()
    assert len(rows) == len(pages)
    by = {r["page_id"]: r for r in rows}
    assert [(by[i]["rule"], by[i]["verdict"]) for i in range(1, 8)] == [("com/en/", "block"), ("example.com/en/7", "allow"), ("net/de/", "allow"), ("example.net/de/8", "block"), (None, "allow"), (None, "allow"), (None, "allow")]
    assert by[179]["verdict"] == "block" and by[379]["verdict"] == "allow" and by[500]["verdict"] == "allow" and by[501]["verdict"] == "allow"
    none = spark.createDataFrame([], "page_id long, bad int")
    assert {r["verdict"] for r in url_filter.judge_urls(df.where("page_id >= 100"), none).collect()} == {"allow"}
    assert url_filter.judge_urls(df.limit(0), none).count() == 0


def test_many_rules(spark, monkeypatch):
    """More rules than an expression takes: a table of them gives what plain Python and the compiled rules give."""
    rng = np.random.default_rng(12)
    labels = ["a", "b", "c", "com", "net", "x-y"]
    hosts = [".".join(rng.choice(labels, rng.integers(1, 5))) for _ in range(400)] + [""]
    paths = ["/" + "/".join(rng.choice(["en", "de", "7"], rng.integers(0, 4))) for _ in range(400)] + [""]
    rules = tuple(url_filter.UrlRule(str(rng.choice(["block", "allow"])), ".".join(rng.choice(labels, rng.integers(1, 4))), paths[i]) for i in range(300))
    df = spark.createDataFrame([(i, f"x://{h}{p}") for i, (h, p) in enumerate(zip(hosts, paths, strict=True))] + [(None, None)], "page_id long, url string")
    none = spark.createDataFrame([], "page_id long, bad int")

    def plain(host, path):
        fit = [(len(r.name), len(r.host), i, r) for i, r in enumerate(rules) if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        return (max(fit)[3].name, max(fit)[3].verdict) if fit else (None, "allow")

    got = url_filter.judge_urls(df, none, rules).collect()
    assert len(got) == 402 and all((r["rule"], r["verdict"]) == plain(r["host"], r["path"]) for r in got)
    assert any(r["rule"] for r in got)
    monkeypatch.setattr(url_filter, "COMPILED_RULES", 1000)
    assert sorted(map(tuple, url_filter.judge_urls(df, none, rules).collect()), key=repr) == sorted(map(tuple, got), key=repr)


def plain_bounds(pages, outcomes):
    """Host: bound, for every host of pages (id, host), by the formulas of url_filter in plain Python."""
    u, labels = url_filter, defaultdict(list)
    for i, bad in outcomes:
        labels[i].append(bad)
    cut = lambda host, n: ".".join(host.split(".")[-n:])
    counts = {level: defaultdict(lambda: [0, 0]) for level in u.LEVELS}
    for i, host in pages:
        for level, key in zip(u.LEVELS, (cut(host, 1), cut(host, 2), host), strict=True):
            for bad in labels[i] or [None]:
                c = counts[level][key]
                c[0] += bad is not None
                c[1] += bad or 0

    def strength(groups):
        groups = [g for g in groups if g[0]]
        n, bad = sum(g[0] for g in groups), sum(g[1] for g in groups)
        rest = n and n - sum(g[0] ** 2 for g in groups) / n
        if not rest:
            return u.STRONGEST
        within = bad / n * (1 - bad / n)
        between = (sum(g[1] ** 2 / g[0] for g in groups) - bad**2 / n - (len(groups) - 1) * within) / rest
        return max(u.WEAKEST, min(u.STRONGEST, (within - between) / between)) if between > 0 else u.STRONGEST

    k = {level: strength(counts[level].values()) for level in u.LEVELS}
    n, bad = (sum(c[x] for c in counts["suffix"].values()) for x in (0, 1))
    out = {}
    for host in counts["host"]:
        mean = bad / n if n else 0.0
        for level, key in zip(u.LEVELS, (cut(host, 1), cut(host, 2), host), strict=True):
            c = counts[level][key]
            mean = (c[1] + k[level] * mean) / (c[0] + k[level])
        out[host] = mean - u.BOUND * (mean * (1 - mean) / (c[0] + k["host"] + 1)) ** 0.5
    return out


def test_hosts_without_labels(spark):
    """A fresh subdomain of a bad domain is blocked; domain, suffix and whole stand in where a host has no labelled page."""
    hosts = {f"h{j}.{name}": bad for name, bad in (("bad.info", 1), ("good.info", 0), ("good.biz", 0), ("bad.dev", 1)) for j in range(6)}
    pages = [(100 * j + i, host) for j, host in enumerate(hosts) for i in range(40)]
    outcomes = [(i, hosts[host]) for i, host in pages]
    unseen = ["fresh.bad.info", "fresh.good.info", "fresh.new.info", "fresh.new.dev", "fresh.new.xyz", "single"]
    pages += [(10_000 + i, host) for i, host in enumerate(unseen)] + [(None, "no-id.bad.dev")]
    df = spark.createDataFrame([(i, f"x://{host}/") for i, host in pages], "page_id long, url string")
    rows = url_filter.judge_urls(df, spark.createDataFrame(outcomes, "page_id long, bad int")).collect()
    assert len(rows) == len(pages)
    by = {r["host"]: r for r in rows}
    want = plain_bounds(pages, outcomes)
    assert by.keys() == want.keys()
    assert all(by[h]["bound"] == pytest.approx(want[h]) for h in want)
    assert [by[h]["verdict"] for h in ("fresh.bad.info", "fresh.good.info", "no-id.bad.dev")] == ["block", "allow", "block"]


def test_every_host_has_a_bound(spark, sf):
    rows = digests.op8_url_filter(spark, sf).collect()
    outcomes = [(r["doc_id"], 1 - r["quality"]) for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if r["quality"] in (0, 1)]
    want = plain_bounds([(r["page_id"], r["host"]) for r in rows], outcomes)
    assert all(r["bound"] == pytest.approx(want[r["host"]], abs=1e-6) for r in rows)


@pytest.mark.parametrize("name", ["op8_url_filter", "op9_lm_score"])
def test_matches_sql(spark, sf, name):
    df = digests.QUERIES[name](spark, sf)
    columns = sorted(df.columns)
    c = duckdb.connect()
    for t in ("documents", "pages", "labels"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    want = c.sql("SELECT " + ", ".join(columns) + f" FROM ({oracles.ORACLES[name]})").fetchall()
    assert sorted(map(tuple, df.select(*columns).collect()), key=repr) == sorted(want, key=repr)


def plain_backoff(texts, order, alpha=0.4):
    """(n_words, n_backed_off, n_unseen, log_score) of each text, by counts of the others."""
    docs = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    grams = [[Counter(zip(*[d[j:] for j in range(k)], strict=False)) for k in range(1, order + 1)] for d in docs]
    whole = [sum((g[k] for g in grams), Counter()) for k in range(order)]
    out = []
    for d, own in zip(docs, grams, strict=True):
        rest, logs, backed = sum(map(len, docs)) - len(d), 0.0, 0
        count = lambda g: whole[len(g) - 1][g] - own[len(g) - 1][g]  # noqa: B023, E731
        for i in range(len(d)):
            longest, factor = min(order, i + 1), 0.0
            for k in range(longest, 0, -1):
                gram = tuple(d[i - k + 1 : i + 1])
                if count(gram) > 0:
                    logs += factor + np.log(count(gram) / (count(gram[:-1]) if k > 1 else rest))
                    break
                factor += np.log(alpha)
            else:
                logs += factor - np.log(rest + 1)
            backed += longest > 1 and count(tuple(d[i - longest + 1 : i + 1])) <= 0
        out.append((len(d), backed, sum(count((w,)) <= 0 for w in d), logs))
    return out


def check_backoff(docs, order, **how):
    rows = docs.select("doc_id", "text").collect()
    want = sorted(((r["doc_id"] is None, r["doc_id"] or 0, *p) for r, p in zip(rows, plain_backoff([r["text"] for r in rows], order), strict=True)))
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_words"], r["n_backed_off"], r["n_unseen"], r["log_score"]) for r in lm_score.stupid_backoff(docs, order=order, **how).collect())
    assert [x[:5] for x in got] == [x[:5] for x in want] and [x[5] for x in got] == pytest.approx([x[5] for x in want])


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_backoff_is_the_plain_one(spark, edge, empty, monkeypatch, order):
    monkeypatch.setattr(lm_score, "BATCH_BYTES", 2_000)
    monkeypatch.setattr(lm_score, "BUCKET_BYTES", 3_000)
    monkeypatch.setattr(lm_score, "HELD_WORDS", 50)
    check_backoff(edge, order)
    assert lm_score.stupid_backoff(empty, order=order).count() == 0
    rng = np.random.default_rng(order)
    docs = [(i, " ".join(rng.choice(list("abcdefgh"), rng.integers(0, 30)))) for i in range(60)]
    check_backoff(spark.createDataFrame(docs + docs[:20], "doc_id long, text string").repartition(3), order)


def test_backoff_by_hand(spark):
    docs = [(1, "a b a b"), (2, "a b c"), (3, "z a c"), (4, None), (4, " ")]
    got = {r["doc_id"]: r for r in lm_score.stupid_backoff(spark.createDataFrame(docs, "doc_id long, text string"), order=2).collect()}
    # Document 2 among the others: a 3, b 2, c 1, z 1 of 7 words; a b 2, b a 1, z a 1, a c 1.
    assert got[2]["log_score"] == pytest.approx(np.log(3 / 7) + np.log(2 / 3) + np.log(0.4 * 1 / 7))
    assert (got[2]["n_words"], got[2]["n_backed_off"], got[2]["n_unseen"]) == (3, 1, 0)
    assert got[3]["n_unseen"] == 1 and got[3]["log_score"] == pytest.approx(np.log(0.4 / 8) + np.log(0.4 * 3 / 7) + np.log(0.4 * 1 / 7))
    assert got[4]["mean_log_score"] is None and got[4]["log_score"] == 0
    three = lm_score.stupid_backoff(spark.createDataFrame([(1, "a b c d"), (2, "x a b c")], "doc_id long, text string"), order=3).where("doc_id = 1").first()
    assert three["log_score"] == pytest.approx(np.log(1 / 4) + np.log(1 / 1) + np.log(1 / 1) + np.log(0.4 * 0.4 * 0.4 / 5))


def plain_statistics(text):
    """STATISTICS character by character."""
    words, lines = (text or "").split(), [x for x in (text or "").split("\n") if x.strip()]
    if not words:
        return [0.0] * len(rule_ensemble.STATISTICS)
    n, chars = len(words), sum(len(w) for w in words)
    count = lambda signs: sum(c in signs for c in text)
    distinct = sum(len(set(words[i : i + rule_ensemble.WINDOW_WORDS])) for i in range(0, n, rule_ensemble.WINDOW_WORDS))
    return [
        np.log1p(n), chars / n, count("#*$%&|<>~^_=+@\\{}") / chars, sum("A" <= c <= "Z" for c in text) / chars, sum("0" <= c <= "9" for c in text) / chars,
        count(".,;:") / n, count("!?") / n, count("|") / n, distinct / n, Counter(words).most_common(1)[0][1] / n, sum(len(w) > 1 and w.isupper() for w in words) / n,
        np.log1p(n / max(1, len(lines))), 1 - len(set(lines)) / max(1, len(lines)), sum(not any(c.isalpha() for c in w) for w in set(words)) / len(set(words)),
    ]


def test_statistics_are_the_plain_ones(documents, edge):
    for docs in (documents, edge):
        for r in docs.select("text").collect():
            assert rule_ensemble.statistics(r["text"]) == pytest.approx(plain_statistics(r["text"]), abs=1e-6)


def test_tree_splits_where_gini_falls_most():
    """One split on one statistic: the threshold is the best of all by brute force, and both sides become rules."""
    rng = np.random.default_rng(3)
    x = rng.integers(0, 20, (400, 1)).astype(float)
    y = ((x[:, 0] > 12) ^ (rng.random(400) < 0.1)).astype(float)
    out = set()
    rule_ensemble.grow(x, y, rng, 1, (), out)
    gini = lambda s: len(s) * s.mean() * (1 - s.mean()) if len(s) else 0.0
    best = min((t for t in range(20) if rule_ensemble.LEAF_ROWS <= (x[:, 0] <= t).sum() <= 400 - rule_ensemble.LEAF_ROWS), key=lambda t: gini(y[x[:, 0] <= t]) + gini(y[x[:, 0] > t]))
    assert {r.terms for r in out} == {((0, False, float(best)),), ((0, True, float(best)),)}
    deep = set()
    rule_ensemble.grow(rng.normal(size=(600, 4)), rng.integers(0, 2, 600).astype(float), rng, 3, (), deep)
    assert all(1 <= len(r.terms) <= 3 for r in deep) and all(rule_ensemble.Rule(r.terms[:-1]) in deep for r in deep if len(r.terms) > 1)


def test_fit_takes_each_id_once(spark, documents, sf):
    """An id that many rows share comes to the driver once."""
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    many = documents.where("doc_id < 40")
    assert rule_ensemble.train(many.unionAll(many).unionAll(many), labels) == rule_ensemble.train(many, labels)


def test_rule_ensemble_learns(spark, sf, documents):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    model = rule_ensemble.train(documents, labels)
    x = rule_ensemble.classify(documents, model)
    frame = x.toPandas()
    assert np.allclose(model.scores(frame[list(rule_ensemble.STATISTICS)].to_numpy()), frame["score"])
    held = x.join(labels, "doc_id").where(rule_ensemble.held_out()).toPandas()
    assert (held["predicted"] == held["quality"]).mean() >= 0.85
    assert rule_ensemble.keep_good(documents, labels).count() == x.where("predicted = 1").count()


def test_lasso_is_sparse_and_right():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(3000, 5))
    y = ((x[:, 1] > 0.3) & (x[:, 3] <= 0.5)).astype(int)
    model = rule_ensemble.fit(x, y)
    assert ((model.scores(x) >= 0.5) == y).mean() > 0.98
    a = rng.integers(0, 2, (500, 30)).astype(float)
    _, w = rule_ensemble.lasso_logistic(a, a[:, 4], l1=0.02)
    assert abs(w[4]) > 1 and (np.abs(np.delete(w, 4)) < 1e-6).all()


def test_classifier_edges(spark, edge, empty):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (6, 1), (7, 5)], "doc_id long, quality int")
    model = rule_ensemble.train(edge, labels)
    rows = rule_ensemble.classify(edge, model).collect()
    assert len(rows) == len(edge_rows()) and all(0 <= r["score"] <= 1 for r in rows)
    assert rule_ensemble.classify(empty, rule_ensemble.train(empty, labels.limit(0))).count() == 0
    assert rule_ensemble.keep_good(edge, labels).columns == edge.columns
    assert rule_ensemble.fit(np.zeros((0, 14)), np.zeros(0, int)).scores(np.zeros((2, 14))).tolist() == [0.5, 0.5]


def test_pipeline(spark, sf, documents):
    """Each stage, on its own input, gives what a plain version gives."""
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "quality", "near_duplicates", "packing"] and corpus_pipeline.ORACLE_SQL is None
    docs = documents
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == documents.columns
        docs, _ = corpus_pipeline.rewritten(spark, out, name)
        kept[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
    whole = {r["doc_id"]: r["text"] for r in documents.collect()}
    assert all(any(c.isalpha() for c in t) for t in kept["language"].values()) and len(kept["language"]) >= 0.98 * len(whole)
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    lost = [d for d in kept["language"] if d not in kept["quality"] and labels.get(d) == 1]
    assert len(lost) <= 0.03 * len(whole)
    ids = sorted(kept["quality"])
    groups = plain_groups(ids, [plain_fingerprint(kept["quality"][i]) for i in ids])
    assert set(kept["near_duplicates"]) == set(groups)
    rows = corpus_pipeline.run(spark, sf).collect()
    tokenizer = packing.byte_tokenizer(**digests.byte_files())
    totals = Counter()
    for r in rows:
        totals[r["doc_id"]] += r["length"]
    assert totals == {i: len(tokenizer.encode(t)) + 1 for i, t in kept["near_duplicates"].items()}


def test_pipeline_stages_on_edges(spark, sf, edge, empty):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, edge, sf).count() > 0
        assert stage(spark, empty, sf).count() == 0


def test_pipeline_without_labels(spark, sf, documents, tmp_path):
    """No language and no quality label: nothing can be learned, so that only texts without letters go before copies do. Clashing ids lose no text."""
    rows = documents.withColumn("lang", F.lit(None).cast("string")).withColumn("doc_id", F.col("doc_id") % 7)
    rows.write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{sf}/labels.parquet").limit(0).write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    kept = [r["text"] for r in docs.collect() if any(map(str.isalpha, r["text"] or ""))]
    for name, stage in corpus_pipeline.STAGES[:2]:
        docs, _ = corpus_pipeline.rewritten(spark, stage(spark, docs, str(tmp_path)), name)
        assert sorted(r["text"] for r in docs.collect()) == sorted(kept)
    groups = plain_keep_one([(i, t) for i, t in enumerate(kept)])
    total = sum(r["length"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect())
    tokenizer = packing.byte_tokenizer(**digests.byte_files())
    sizes = [[len(tokenizer.encode(t)) + 1 for _, t in members] for _, members in groups]
    assert sum(map(min, sizes)) <= total <= sum(map(max, sizes))
