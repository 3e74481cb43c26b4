"""BPE, suffix-array dedup, quality rules, language identification."""

import collections
import hashlib
import random
import re
import unicodedata

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tripleloom.llm import bpe, langid, quality, suffix

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [None, "", " \n\t", "Don't STOP!!! 123 ½", "ΣΑΣ İ ﬁ é e\u0301", "<|endoftext|>x<|startoftext|>", "<|ENDOFTEXT|>", "a" * 3000, "日本語 テスト 😀😀", "x\u00a0y\u2003z", "'s 'LL we'Ve"]


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


def test_bpe_equals_the_library(tokenizer):
    with open(PATH, "rb") as f:
        tool = bpe.Encoder(f.read())
    rng = random.Random(2)
    vocabulary = [t.replace("</w>", "") for t in tokenizer.get_vocab()]
    texts = [t or "" for t in ODD]
    texts += ["".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 5))) for _ in range(3000)]
    texts += ["".join(rng.choice(["a", "an", "ana", "th", "he", "er", "in", "g"]) for _ in range(rng.randrange(40))) for _ in range(2000)]
    texts += ["".join(rng.choice("abcdeéßñ '.,!*#12\n") for _ in range(rng.randrange(60))) for _ in range(2000)]
    for t in texts:
        want = tokenizer.encode(t, add_special_tokens=False).ids
        assert tool.encode(t) == want
        assert tool.decode(np.array(want, np.int64)).decode() == tokenizer.decode(want, skip_special_tokens=False)


def test_bpe_knows_every_code_point(tokenizer):
    """Also those that are newer than Python's tables, or than the library's."""
    with open(PATH, "rb") as f:
        tool = bpe.Encoder(f.read())
    points = [c for c in range(0x80, 0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x3000 or c % 7 == 0 or unicodedata.category(chr(c)) == "Cn" and c < 0x40000)]
    for at in range(0, len(points), 50_000):
        texts = [f"x{chr(c)}y 1{chr(c)}" for c in points[at : at + 50_000]]
        wrong = [hex(ord(t[1])) for t, w in zip(texts, tokenizer.encode_batch(texts, add_special_tokens=False), strict=True) if tool.encode(t) != w.ids]
        assert not wrong


def test_bpe_frames(spark, tokenizer):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(ODD)] + [(None, "a b", "x")], "doc_id long, text string, ids string")
    rows = bpe.encode(df, PATH).collect()
    assert len(rows) == len(ODD) + 1
    for r in rows:
        if r.doc_id is not None:
            ids = tokenizer.encode(ODD[r.doc_id] or "", add_special_tokens=False).ids
            assert (r.ids, r.n_tokens) == (ids, len(ids))
            assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
            assert r.decoded_sha256 == hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    back = {r.doc_id: r.text for r in bpe.decode(bpe.encode(df, PATH), PATH).collect()}
    assert back[1] == "" and back[9] == "x</w> y</w> z</w>"
    assert bpe.encode(df.limit(0), PATH).count() == 0
    twice = bpe.encode(df.union(df), PATH, with_ids=False).collect()
    assert len(twice) == 2 * len(rows) and len(set(twice)) == len({(r.doc_id, r.ids_sha256) for r in rows})


def brute_repeats(texts, length, keep_first=False):
    places = collections.defaultdict(list)
    for r, t in enumerate(texts):
        for i in range(len(t) - length + 1):
            places[t[i : i + length]].append((r, i))
    gone = [set() for _ in texts]
    for at in places.values():
        if len(at) > 1:
            for r, i in at[1 if keep_first else 0 :]:
                gone[r].update(range(i, i + length))
    return gone


def check_suffix(spark, docs, length, **options):
    keep_first = options.get("keep_first", False)
    df = spark.createDataFrame([(i, t, 0) for i, t in enumerate(docs)], "doc_id long, text string, row int")
    data = [(t or "").encode() for t in docs]
    gone = brute_repeats(data, length, keep_first)
    rows = {r.doc_id: r for r in suffix.remove_repeats(df, length, **options).collect()}
    for i, t in enumerate(data):
        kept = bytes(c for k, c in enumerate(t) if k not in gone[i])
        spans = sum(k - 1 not in gone[i] for k in gone[i])
        r = rows[i]
        assert (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept), r.kept_sha256) == (len(t), len(gone[i]), spans, kept, hashlib.sha256(kept).hexdigest())


@pytest.mark.parametrize("most", [2000, 2])
@pytest.mark.parametrize("keep_first", [False, True])
def test_suffix_dedup(spark, most, keep_first):
    rng = random.Random(4)
    base = ["".join(rng.choice("abcdé ") for _ in range(rng.randrange(10, 90))) for _ in range(20)]
    docs = ["".join(rng.choice(base) for _ in range(rng.randrange(4))) + "".join(rng.choice("xyz") for _ in range(rng.randrange(30))) for _ in range(80)]
    docs += ["a" * 100, "ab" * 60, "a" * 30 + "b" + "a" * 30, "abcab" * 20, "", None, "short"]
    check_suffix(spark, docs, 20, most=most, keep_first=keep_first)


@pytest.mark.parametrize("most", [2000, 3])
def test_suffix_passages_and_periods(spark, most):
    """Passages that many documents share, at random places, and periods longer and shorter than an anchor."""
    rng = random.Random(11)
    letters = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    shared = [letters(70), letters(41), letters(150)]
    docs = [letters(rng.randrange(60)) + shared[i % 3][rng.randrange(5) :] + letters(rng.randrange(60)) for i in range(60)]
    for period in (1, 2, 7, 9, 11, 25, 39, 40, 41):
        unit = letters(period)
        docs.append((unit * (300 // period))[: 200 + period])
    docs.append("q" * 500 + "r" + "q" * 300)
    check_suffix(spark, docs, 40, most=most)
    check_suffix(spark, docs, 40, most=most, keep_first=True)


def test_suffix_long_texts(spark):
    rng = np.random.default_rng(5)
    noise = rng.integers(97, 123, 5_000_000, np.uint8).tobytes().decode()
    docs = [noise, "x" * 2_000_000, noise[1_200_000:1_200_900] + "tail", "abcdefg" * 100_000]
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    got = {r.doc_id: (r.n_removed, r.n_spans) for r in suffix.remove_repeats(df, with_kept=False).collect()}
    assert got == {0: (900, 1), 1: (2_000_000, 1), 2: (900, 1), 3: (700_000, 1)}


def test_suffix_repeated_ids(spark):
    df = spark.createDataFrame([(None, "q" * 30), (1, "abcdefghij" * 3), (1, "x" + "abcdefghij" * 3)], "doc_id long, text string")
    rows = sorted((r.n_bytes, r.n_removed) for r in suffix.remove_repeats(df, 25, with_kept=False).collect())
    assert rows == [(30, 30), (30, 30), (31, 30)]
    assert suffix.remove_repeats(df.limit(0), 25).count() == 0


def test_longest_previous_factor():
    s = b"abaabababbabbb"
    order = sorted(range(len(s)), key=lambda i: s[i:])
    common = lambda x, y: next((k for k in range(min(len(x), len(y))) if x[k] != y[k]), min(len(x), len(y)))
    lcp = np.array([0] + [common(s[i:], s[j:]) for i, j in zip(order, order[1:], strict=False)])
    longest = lambda i, other: max((common(s[i:], s[j:]) for j in other), default=0)
    assert suffix.previous_factor(np.array(order), lcp).tolist() == [longest(i, range(i)) for i in range(len(s))]
    assert suffix.previous_factor(np.array(order), lcp, False).tolist() == [longest(i, range(i + 1, len(s))) for i in range(len(s))]


def test_families_are_suffix_orders():
    rng = random.Random(3)
    contents = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(12, 30))) for _ in range(60)]
    contents += contents[:5]
    at = np.array([rng.randrange(len(c)) for c in contents])
    for d, order, lcp in suffix.families(contents, at, 9):
        cut = {i: contents[i][at[i] - d : at[i] + 9] for i in range(len(contents)) if at[i] >= d}
        assert sorted(order.tolist()) == sorted(cut) and [cut[i] for i in order.tolist()] == sorted(cut.values())
        for k in range(1, len(order)):
            x, y = cut[order[k - 1]], cut[order[k]]
            assert lcp[k] == next((j for j in range(min(len(x), len(y))) if x[j] != y[j]), min(len(x), len(y)))


def base_rules(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
    windows = collections.Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    cover = {k for i in range(len(w) - 7) if windows[tuple(w[i : i + 8])] > 1 for k in range(i, i + 8)}
    seen, dup = set(), 0
    for line in (t or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    n = len(w)
    return n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), dup, len(cover), n < 20 or 100 * len(cover) > 30 * n


def test_quality(spark):
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefg") for _ in range(rng.randrange(1, 9))) for _ in range(500)]
    prose = lambda n: ". ".join(" ".join(rng.choice(words) for _ in range(10)) for _ in range(n))
    texts = [prose(rng.randrange(4, 40)) for _ in range(120)]
    junk = ["".join(w + "###*** " for w in prose(20).split()) for _ in range(5)]
    odd = [None, "", " \x0b\n", "a b " * 30, "one\ntwo\none\n \none", " lead and trail ", "ä ö|ü <x>", "a b c d e f g h " * 2 + prose(3)]
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts + junk + odd)] + [(900, texts[0], None, None, 0), (901, junk[0], "de", "few", 0)]
    got = {r.doc_id: r for r in quality.quality(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, d int")).collect()}
    for i, t, *_ in rows:
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base_rules(t)
        assert not (r.base_failed and r.kept)
    assert sum(not got[i].kept for i in range(120)) <= 1
    assert not any(got[120 + i].kept for i in range(5))
    assert got[900].kept and not got[901].kept  # small groups are judged by larger ones
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert quality.quality(empty).count() == 0


def test_mcd_ignores_outliers(spark):
    rng = np.random.default_rng(3)
    core = rng.normal([5, 1, 0.5, 1, 0.2], [2, 0.3, 0.2, 1, 0.3], (300, 5))
    far = rng.normal(30, 1, (60, 5))
    rows = [("en", "s", *map(float, x)) for x in np.vstack([core, far])]
    fit = quality.estimate(spark.createDataFrame(rows, "lang string, source string, " + ", ".join(f"{f} double" for f in quality.FEATURES))).first()
    assert abs(fit.m_f_words - 5) < 0.5 and abs(fit.l_f_words_f_words - 2) < 0.7


def brute_determinant(x, starts, rng):
    """Least log determinant of the nearest three quarters, by concentration from many random starts."""
    h, best = int(np.ceil(0.75 * len(x))), np.inf
    for _ in range(starts):
        at = rng.choice(len(x), 12, replace=False)
        for _ in range(40):
            m, c = x[at].mean(axis=0), np.cov(x[at].T, bias=True) + 1e-9 * np.eye(x.shape[1])
            y = x - m
            at = np.argsort((y @ np.linalg.inv(c) * y).sum(axis=1))[:h]
        best = min(best, np.linalg.slogdet(np.cov(x[at].T, bias=True))[1])
    return best


@pytest.mark.parametrize("seed", range(3))
def test_mcd_against_random_starts(spark, seed):
    """No features below their resolution, a correlated core, and a fifth of rows elsewhere."""
    rng = np.random.default_rng(seed)
    mix = rng.normal(size=(5, 5))
    core = rng.normal(size=(240, 5)) @ mix * 2 + [6, 2, 3, 4, 2]
    far = rng.normal(size=(60, 5)) * 0.5 + np.array([6, 2, 3, 4, 2]) + 9 * mix[0]
    x = np.vstack([core, far])
    rows = spark.createDataFrame([(0, "en", "s", *map(float, r)) for r in x], "level int, lang string, source string, " + ", ".join(f"{f} double" for f in quality.FEATURES))
    fit = quality.minimum_determinant(rows).first()
    assert fit.logdet < brute_determinant(x, 200, rng) + 0.1


def test_quality_ties_repeats_and_long_texts(spark):
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdefg") for _ in range(rng.randrange(1, 9))) for _ in range(500)]
    same = " ".join(rng.choice(words) for _ in range(80))
    rows = [(1, same, "en", "s", "c")] * 60 + [(2, " ".join(rng.choice(words) for _ in range(300_000)), "en", "s", "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, f_words string")
    got = quality.quality(df).collect()
    assert len(got) == 61 and all(r.kept for r in got if r.doc_id == 1)
    assert [(r.n_words, r.base_failed) for r in got if r.doc_id == 2] == [(300_000, False)]


def test_language(spark):
    rng = random.Random(6)
    stock = {"aa": "aba abo obo lala mama", "bb": "zyx xyz yzz xzx wyw", "cc": "éçè èéç çèé êéè"}
    rows = []
    for i in range(400):
        lang = rng.choice(list(stock))
        rows.append((i, " ".join(rng.choice(stock[lang].split()) for _ in range(rng.randrange(3, 60))), lang, "s"))
    rows += [(1000, None, "aa", "s"), (1001, "", None, "s"), (1002, "123 !!", "bb", "s"), (1003, "aba " * 30000, None, "s"), (None, "zyx xyz", "bb", "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string")
    got = {r.doc_id: r for r in langid.identify(df).collect()}
    assert len(got) == len(rows)
    import zlib

    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items() if i is not None) and got[None].held_out is False
    assert [(got[i].lang_pred, got[i].score) for i in (1000, 1001, 1002)] == [("und", 0.0)] * 3
    assert got[1003].lang_pred == "aa"
    held = [r for r in rows if r[0] is not None and r[0] < 1000 and got[r[0]].held_out]
    assert np.mean([got[r[0]].lang_pred == r[2] for r in held]) > 0.95
    assert all(0 <= r.score <= 1 for r in got.values())
    kept = langid.keep_identified(df)
    assert kept.columns == df.columns and kept.filter("doc_id in (1000, 1001, 1002)").count() == 0
    none = langid.identify(df.withColumn("lang", df.lang.substr(100, 1)).filter("lang = 'none'"))
    assert none.count() == 0
    assert {r.lang_pred for r in langid.identify(spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")).collect()} == {"und"}


def test_segments_count_each_gram_once(monkeypatch):
    rng = random.Random(2)
    text = "".join(rng.choice("abİΣéx -1") for _ in range(5000))
    whole = langid.counts(text)
    for size in (1, 2, 3, 7, 1000):
        monkeypatch.setattr(langid, "SEGMENT", size)
        assert np.array_equal(langid.counts(text), whole)
    n = len(text.lower())
    assert whole.sum() == 3 * n - 3


def test_language_repeats_and_ties(spark):
    rows = [(i % 3, "aba abo" if i % 2 else "zyx xyz", "aa" if i % 2 else "bb", "a") for i in range(40)] + [(7, "aba abo", "bb", "a")]
    got = langid.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")).collect()
    assert len(got) == 41 and len({(r.lang_pred, r.score) for r in got}) == 2


def test_quality_judges_small_groups(spark):
    rng = random.Random(7)
    words = ["".join(rng.choice("abcdefg") for _ in range(rng.randrange(1, 9))) for _ in range(500)]
    prose = lambda: " ".join(rng.choice(words) for _ in range(rng.randrange(40, 300)))
    junk = "".join(w + "###*** " for w in prose().split())
    rows = [(i, prose(), "en", f"s{i % 20}") for i in range(120)] + [(200, junk, "en", "s1"), (201, junk, "de", "few"), (202, prose(), "de", "few"), (203, junk, None, None)]
    got = {r.doc_id: r for r in quality.quality(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert sum(not got[i].kept for i in range(120)) <= 2 and got[202].kept
    assert not any(got[i].kept for i in (200, 201, 203)) and all(r.distance is not None for r in got.values())
    few = quality.quality(spark.createDataFrame(rows[:8] + rows[120:121], "doc_id long, text string, lang string, source string")).collect()
    assert [r.doc_id for r in few if not r.kept] == [200]


def test_quality_rejects_separators_in_clean_groups(spark):
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefg") for _ in range(rng.randrange(1, 9))) for _ in range(500)]
    prose = lambda n: [rng.choice(words) for _ in range(n)]
    rows = [(i, " ".join(prose(rng.randrange(30, 600))), "en", "s") for i in range(150)]
    rows += [(200 + i, " ".join(w + " |" * (k % 2) for k, w in enumerate(prose(rng.randrange(60, 300)))), "en", "s") for i in range(5)]
    rows += [(300, " ".join(prose(200)) + " R & D & more", "en", "s")]
    got = {r.doc_id: r.kept for r in quality.quality(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert sum(not got[i] for i in range(150)) <= 1 and got[300]
    assert not any(got[200 + i] for i in range(5))
