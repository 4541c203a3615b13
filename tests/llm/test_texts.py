"""Quality rules, tokenization, packing and language, against plain versions."""

import hashlib
import math
import random
import unicodedata
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyframe.llm import bpe, digests, language, oracles, packing, quality_rules

from .conftest import edge_rows

LETTERS = [*"abcXYZ'stredv 019_.,!?\t\n\r\x0b\x1c\x85\u00a0ÉéßΣσςİıñ中文кирأ😀½٣ⅷ<|>", "<|endoftext|>", "<|startoftext|>", "'s", "'ll"]


def mixed(n, most=30, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(LETTERS) for _ in range(rng.randint(0, most))) for _ in range(n)]


def plain_repeats(words):
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = set()
    for i, w in enumerate(zip(words, words[1:], words[2:], strict=False)):
        if windows[w] > 1:
            covered |= {i, i + 1, i + 2}
    return len(covered)


def test_repeat_words():
    rng = random.Random(2)
    for _ in range(300):
        words = [rng.choice("abc").encode() for _ in range(rng.randint(0, 25))]
        assert quality_rules.repeat_words(words) == plain_repeats(words)


def test_line_rules():
    verdict = quality_rules.line_verdict
    assert verdict("Home | News | About") == "navigation"
    assert verdict("All Rights Reserved.") == "boilerplate"
    assert verdict("### $$$ word.") == "boilerplate"
    assert verdict("no mark at all") == "punctuation"
    assert verdict("A sentence.") == ""
    # Phrases count as whole words, and only where they are a good part of the line.
    assert verdict("They hung a sign in the window, and people stopped to read it every day.") == ""
    assert verdict("Assign income to each.") == "" and verdict("Please sign in to read on.") == "boilerplate"
    assert verdict("By using this site you agree to our Privacy Policy and Terms of Use.") == "boilerplate"


def test_frames_in_four_languages():
    bad = ["Iniciar sesión para continuar.", "Alle Rechte vorbehalten. Cookie-Richtlinie.", "Tous droits réservés.", "POLÍTICA DE COOKIES.", "Conditions d'utilisation.", "Click here."]
    good = ["Los derechos de los vecinos quedaron sin respuesta durante años.", "Die Rechte der Bauern wurden im Vertrag lange nicht genannt.", "Le droit de pêche reste aux habitants du village.", "Saltaron al contenido del cofre y hallaron cartas viejas de la abuela."]
    assert [quality_rules.line_verdict(x) for x in bad] == ["boilerplate"] * len(bad)
    assert [quality_rules.line_verdict(x) for x in good] == [""] * len(good)


def test_rules_reject_what_loses_too_much(spark):
    good = "\n".join(f"Sentence{i} says{i} thing{i} on{i} matter{i} of{i} note{i}." for i in range(20))
    bad = good + "\n" + "\n".join(f"Home | Page{i} | About" for i in range(600))
    got = quality_rules.line_first_rules(spark.createDataFrame([(1, good), (2, bad)], "doc_id long, text string")).orderBy("doc_id").collect()
    assert [r["kept"] for r in got] == [True, False] and got[1]["cleaned_text"] == good


def test_rules_on_edges(edge, empty):
    got = quality_rules.line_first_rules(edge).collect()
    assert len(got) == len(edge_rows()) and quality_rules.line_first_rules(empty).count() == 0
    for r in got:
        if r["n_words"] == 0:
            assert r["base_failed"] and not r["kept"] and r["lost_chars"] == 0


def test_rules_match_sql(spark, sf):
    df = digests.op1_quality_rules(spark, sf)
    columns = sorted(df.columns)
    c = duckdb.connect()
    c.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    want = c.sql("SELECT " + ", ".join(columns) + f" FROM ({oracles.ORACLES['op1_quality_rules']})").fetchall()
    assert sorted(map(tuple, df.select(*columns).collect())) == sorted(want)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def test_bpe_is_the_librarys(library):
    mine = bpe.WordBpe(public_tokenizers.path("word_bpe_49k.json"))
    for text in [*mixed(3000), "a" * 3000, "thing" * 2000, "ab " * 100]:
        want = library.encode(text, add_special_tokens=False).ids
        ids, decoded = mine.encode(text)
        ids = np.frombuffer(ids, "<u4").tolist()
        assert ids == want and decoded == library.decode(want, skip_special_tokens=False) == mine.decode(ids)


def test_bpe_cache_turnover(library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 5)
    mine = bpe.WordBpe(public_tokenizers.path("word_bpe_49k.json"))
    for text in mixed(200, 60, seed=4):
        assert np.frombuffer(mine.encode(text)[0], "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_pair_tree():
    rng = random.Random(5)
    for n in (1, 2, 3, 7, 8, 9):
        keys = [rng.randint(0, 20) << 4 | i for i in range(n)]
        tree = bpe.PairTree(keys.copy())
        for _ in range(30):
            assert tree.tree[1] == min(keys)
            i = rng.randrange(n)
            keys[i] = rng.choice([bpe.NONE, rng.randint(0, 20) << 4 | i])
            tree.put(i, keys[i])


def test_bpe_query(edge, empty, documents, library):
    path = public_tokenizers.path("word_bpe_49k.json")
    assert bpe.encode_texts(empty, path).count() == 0
    for docs in (edge, documents):
        want = Counter()
        for r in docs.select("doc_id", "text").collect():
            ids = library.encode(r["text"] or "", add_special_tokens=False).ids
            digest = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
            want[r["doc_id"], len(ids), digest, hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()] += 1
        assert Counter(map(tuple, bpe.encode_texts(docs, path, outputs=False).collect())) == want
    full = bpe.encode_texts(edge, path).where("doc_id = 4").first()
    assert full["decoded"] == library.decode(full["ids"], skip_special_tokens=False)


def test_byte_ids_are_the_librarys():
    t = packing.byte_tokenizer(**digests.byte_files())
    for text in [*mixed(3000, seed=7), "x" * 4000, "word " * 500]:
        assert t.encode(text) == t.library.encode(text, add_special_tokens=False).ids


def test_differencing_keeps_all_and_balances():
    rng = random.Random(3)
    for k in (1, 2, 5, 12):
        sizes = [rng.randint(1, 500) for _ in range(8 * k)]
        parts = packing.differencing(sizes, k)
        assert sorted(i for p in parts for i in p) == list(range(len(sizes))) and len(parts) == k
        sums = [sum(sizes[i] for i in p) for p in parts]
        assert max(sums) - min(sums) <= 60
    assert packing.differencing([], 3) == [[], [], []]


def test_window_count_rises():
    windows = packing.pack_block([700] * 4, 1000)
    assert len(windows) == 4
    for n in (1, 2, 50):
        for w in packing.pack_block([512] * n, 2048):
            assert 512 * len(w) <= 2048


def check_packing(docs):
    tokenizer = packing.byte_tokenizer(**digests.byte_files())
    rows = packing.pack_documents(docs, **digests.byte_files()).collect()
    want = Counter()
    for r in docs.select("doc_id", "text").collect():
        want[r["doc_id"], tuple(tokenizer.library.encode(r["text"] or "", add_special_tokens=False).ids + [packing.END_ID])] += 1
    by = defaultdict(list)
    for (i, ids), n in want.items():
        by[i] += [ids] * n
    covered = defaultdict(Counter)
    for r in rows:
        # Ids may repeat: the piece is a cut of some document with its id and length.
        assert any(len(ids) == r["doc_tokens"] and list(ids[r["start"] : r["start"] + r["length"]]) == r["ids"] for ids in by[r["doc_id"]])
        assert r["length"] == len(r["ids"]) > 0 and r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        covered[r["doc_id"], r["doc_tokens"]].update(range(r["start"], r["start"] + r["length"]))
    for i, texts in by.items():
        for size, n in Counter(map(len, texts)).items():
            assert covered.pop((i, size)) == Counter(dict.fromkeys(range(size), n))
    assert not covered
    assert sum(r["length"] for r in rows) == sum(len(ids) * n for (_, ids), n in want.items())
    held = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == held.get(r["sequence_id"], 0)
        held[r["sequence_id"]] = r["offset"] + r["length"]
    assert not held or max(held.values()) <= packing.WINDOW
    return held


def test_packing(edge, empty, documents):
    check_packing(edge)
    assert not check_packing(empty)
    held = check_packing(documents)
    assert sum(held.values()) >= 0.97 * packing.WINDOW * len(held)


def plain_viterbi(scores, penalty):
    k, n = scores.shape
    best = [(scores[i, 0], [i]) for i in range(k)]
    for t in range(1, n):
        best = [max(((v - penalty * (p[-1] != i) + scores[i, t], [*p, i]) for v, p in best), key=lambda x: x[0]) for i in range(k)]
    return max(v for v, _ in best)


def test_viterbi_finds_the_best_path():
    rng = np.random.default_rng(4)
    table = -rng.exponential(3, (3, 50)).astype(np.float32)
    found = [rng.integers(0, 50, n) for n in (0, 1, 2, 9, 30, 30, 4)]
    for index, path in zip(found, language.viterbi(table, found, 4.0), strict=True):
        assert len(path) == len(index)
        if len(index):
            value = sum(float(table[p, i]) for p, i in zip(path, index, strict=True)) - 4.0 * int((np.diff(path) != 0).sum())
            assert value == pytest.approx(plain_viterbi(table[:, index], 4.0), abs=1e-4)


def test_language_spans_and_scripts(spark):
    en, fr, ru = "the cat sat on the mat with another thing ", "le chat est dans la maison avec une autre chose ", "кошка сидит на ковре и смотрит в окно "
    docs = spark.createDataFrame([(i, t * 20, l) for i, (t, l) in enumerate([(en, "en"), (fr, "fr"), (ru, "ru")] * 6)], "doc_id long, text string, lang string")
    model = language.train(docs)
    text = en * 3 + ru * 2 + fr * 3
    got = language.identify(spark.createDataFrame([(1, text), (2, None), (3, "12 34"), (4, "中文字"), (5, "кошка"), (6, "½ ²")], "doc_id long, text string"), model)
    by = {r["doc_id"]: r for r in got.collect()}
    assert [s["lang"] for s in by[1]["spans"]] == ["en", "ru", "fr"] and 0 < by[1]["score"] < 1
    assert text[by[1]["spans"][1]["start"] : by[1]["spans"][1]["end"]].strip() == (ru * 2).strip()
    assert by[2]["lang_pred"] == by[3]["lang_pred"] == by[6]["lang_pred"] == "und" and by[4]["lang_pred"] in model.languages and by[4]["score"] == 0
    assert by[5]["lang_pred"] == "ru" and by[5]["score"] == 1


def test_language_accuracy(spark, sf, documents):
    got = digests.op5_language(spark, sf).join(documents.select("doc_id", "lang"), "doc_id")
    assert got.count() == documents.count()
    held = got.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert held >= 0.95


def test_language_on_edges(edge, empty):
    model = language.train(edge)
    assert language.identify(edge, model).count() == len(edge_rows())
    assert language.identify(empty, language.train(empty)).count() == 0
    assert {r["lang_pred"] for r in language.identify(edge, language.train(empty)).collect()} == {"und"}
    kept = language.keep_identified(edge)
    assert kept.columns == edge.columns and 0 < kept.count() < len(edge_rows())


def plain_words(text):
    """Runs of letters with the marks that follow them, by Unicode category."""
    words, word = [], ""
    for c in [*(text or ""), " "]:
        kind = unicodedata.category(c)[0]
        if kind == "L" or (kind == "M" and word):
            word += c
        elif word:
            words.append(word)
            word = ""
    return words


def plain_grams(word):
    """Buckets of a word's n-grams within its bounds."""
    padded = "\x02" + word.lower() + "\x02"
    for n in range(1, language.MAX_GRAM + 1):
        for i in range(len(padded) - n + 1):
            gram = padded[i : i + n]
            if gram != "\x02":
                h = 0
                for c in gram:
                    h = (h * 1_000_003 + ord(c)) * 0x9E3779B97F4A7C15 % 2**64
                yield (h >> 40) % language.BUCKETS


def plain_model(rows):
    """rows (text, lang): languages by falling count, logs of shares by language and bucket, candidates of each script."""
    names = [l for l, _ in sorted(Counter(l for _, l in rows).items(), key=lambda x: (-x[1], x[0]))]
    grams, scripts = {l: Counter() for l in names}, {l: Counter() for l in names}
    for text, l in rows:
        for w in plain_words(text):
            grams[l].update(plain_grams(w))
            scripts[l][language.script_of(w)] += len(w)
    logs = {l: (lambda g, whole: lambda b: math.log((g[b] + 0.2) / whole))(grams[l], sum(grams[l].values()) + 0.2 * language.BUCKETS) for l in names}
    return names, logs, {l: {s for s, n in scripts[l].items() if n >= max(1, language.SCRIPT_SHARE * sum(scripts[l].values()))} for l in names}


def plain_identify(text, model):
    names, logs, allowed = model
    words = plain_words(text)
    if not words or not names:
        return "und", 0.0
    value, back = {l: 0.0 for l in names}, []
    for t, w in enumerate(words):
        some = [l for l in names if language.script_of(w) in allowed[l]]
        raw = {l: sum(map(logs[l], plain_grams(w))) for l in some}
        own = {l: max(raw[l] - max(raw.values()), -language.WORD_CAP) if l in raw else (-language.WORD_CAP if some else 0.0) for l in names}
        if t:
            top = max(names, key=lambda l: value[l])
            back.append({l: l if value[l] >= value[top] - language.SWITCH_PENALTY else top for l in names})
            value = {l: max(value[l], value[top] - language.SWITCH_PENALTY) + own[l] for l in names}
        else:
            value = own
    path = [max(names, key=lambda l: value[l])]
    for step in reversed(back):
        path.append(step[path[-1]])
    letters = Counter()
    for w, l in zip(words, reversed(path), strict=True):
        letters[l] += len(w)
    best = max(names, key=lambda l: letters[l])
    return best, letters[best] / sum(letters.values())


def test_identify_is_the_plain_version(spark, documents):
    docs = documents.where("length(text) < 2500").limit(60).collect()
    extra = ["हिन्दी भाषा में लिखा हुआ एक वाक्य", "e\u0301te\u0301 un deux trois", "one two 3four ½ ² five"]
    train = [(r["doc_id"], r["text"], r["lang"]) for r in docs if r["lang"]] + [(9000 + i, extra[0] * 5, "hi") for i in range(3)]
    model = language.train(spark.createDataFrame(train, "doc_id long, text string, lang string"))
    plain = plain_model([(t, l) for _, t, l in train])
    assert model.languages == plain[0]
    texts = [r["text"] for r in docs] + extra + [extra[0] + docs[0]["text"][:300] + extra[0], "", None]
    got = language.identify(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect()
    for r in got:
        want, score = plain_identify(texts[r["doc_id"]], plain)
        assert r["lang_pred"] == want and r["score"] == pytest.approx(score, abs=1e-9)
    assert len(got) == len(texts)


def test_words_hold_their_marks():
    assert language.words_of("हिन्दी भाषा") == ["हिन्दी", "भाषा"] == plain_words("हिन्दी भाषा")
    for text in ["ภาษาไทย", "e\u0301a\u0300 \u0301x", "à½b ⅷ ²", "العَرَبِيَّة"]:
        assert language.words_of(text) == plain_words(text) == [m[0] for m in language.word_pattern(text).finditer(text)]


def test_many_languages(spark):
    """Over 256 languages; each text is named by its own."""
    rng = random.Random(9)
    letters = [chr(c) for c in (*range(0x61, 0x7B), *range(0xE0, 0xF7), *range(0x430, 0x450))]
    words = ["".join(rng.choice(letters) for _ in range(8)) for _ in range(3000)]
    texts = [(i, " ".join(words[10 * i : 10 * i + 10] * 3), f"l{i:03}") for i in range(300)]
    docs = spark.createDataFrame(texts, "doc_id long, text string, lang string")
    model = language.train(docs)
    assert len(model.languages) == 300 and model.block_words == language.SCORES // 300
    assert all(r["lang_pred"] == f"l{r['doc_id']:03}" and r["score"] == 1 for r in language.identify(docs, model).collect())


def test_no_label_rejects_no_letters(spark):
    rows = [(i, "some words here", None) for i in range(20)] + [(30, "12 34", None), (31, None, None), (32, "", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {r["doc_id"] for r in language.keep_identified(docs.where("lang IS NULL")).collect()} == set(range(20))
    assert {r["doc_id"] for r in language.keep_identified(docs).collect()} >= set(range(20))


def test_long_runs_are_found_wherever_they_begin():
    from tallyframe.llm.packing import LONG_RUN, has_long_run

    for before in (0, 1, 999, 1000, 1001, 1999, 2345):
        for n in (1999, 2000, 2001, 2999):
            for text in ("b " * before + "é" * n, " " * before + "x" * n + " y" * 700, "x" * before + " " + "y" * n):
                assert has_long_run(text) == (LONG_RUN.search(text) is not None)
