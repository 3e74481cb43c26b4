"""Surrogates, decontamination, the pipeline."""

import random
import re

import numpy as np
import pytest

import corpus_pipeline
from tripleloom.llm import common, decontam, pii

KEY = b"of the tests"
SAMPLES = [
    ("a@b.com and A@B.COM", 2),
    ("call +44 20 7946 0958 or (555) 123-4567.", 2),
    ("4111-1111-1111-1111 and 4111111111111111", 2),
    ("at 10.0.0.1, v1.2.3.4.5 no", 1),
    ("DE89 3704 0044 0532 0130 00", 1),
    ("password: 'hunter22' token=\"0123456789abcdef0123456789abcdef01234567\"", 2),
    ("Mrs. Anna Smith met Herr Müller", 3),
    ("г-н Иван Петров", 2),
    ('password="********"', 1),
    ("пароль: 'секрет'; token='ключ-№7'", 2),
    ("api_key=Zk3Q99xx, password: please, secret: hunter2xyz.", 2),
    ("Mrs Anna Smith left. Anna Smith returned. Ms Smith spoke. Anna said: Annaba", 6),
    ("le secret: peut-être, password: amazing! pwd=a_b_c_d", 1),
    ("Contact: Jane O'Neil-Poe\nJane's card 4111111111111112, 000-12-3456", 3),
    ("2001:db8:85a3::8a2e:370:7334 at 10:30:00", 1),
    ("password='é' secret='\u0b83\u0b83\u0b83\u0b83\u0b83\u0b83'", 1),
    ("plain text, 12 words, 3.5 and 2001-01-01", 0),
    (None, 0),
    ("", 0),
]


def test_find_and_replace(spark):
    df = spark.createDataFrame([(i, t, 0, "x") for i, (t, _) in enumerate(SAMPLES)], "doc_id long, text string, n_entities int, made string")
    rows = {r.doc_id: r for r in pii.pseudonymise(df, KEY).collect()}
    for i, (t, n) in enumerate(SAMPLES):
        r = rows[i]
        assert r.n_entities == n and r.made == "x"
        assert (r.text == t) == (n == 0)
        for a, b, _, _ in pii.find(t):
            assert not re.search(rf"(?<!\w){re.escape(t[a:b])}(?!\w)", r.text)
    one, two = rows[0].text.split(" and ")
    assert one.upper() == two and one.endswith(".com")
    assert rows[2].text.split(" and ")[0].replace("-", "") == rows[2].text.split(" and ")[1]
    assert pii.luhn(rows[2].text.split(" and ")[1]) == 0
    assert rows[1].text.startswith("call +44 ") and len(rows[1].text) == len(SAMPLES[1][0])
    assert rows[6].text.split()[1] in pii.GIVEN["latin", "f"] and pii._script(rows[7].text) == "cyrillic"
    assert pii._mod97(rows[4].text.replace(" ", "")) == 1 and rows[4].text[:2] == "DE"
    words = rows[11].text.replace(".", "").split()
    assert words[1] == words[4] == words[10] == rows[6].text.split()[1] and words[2] == words[5] == words[8] and words[12] == "Annaba"
    assert pii.pseudonymise(df.limit(0), KEY).count() == 0
    twice = pii.pseudonymise(df.union(df), KEY).collect()
    assert sorted((r.doc_id, r.text or "") for r in twice) == sorted([(i, r.text or "") for i, r in rows.items()] * 2)
    other = {r.doc_id: r.text for r in pii.pseudonymise(df, b"another").collect()}
    assert all(other[i] != rows[i].text for i, (_, n) in enumerate(SAMPLES) if n)


def test_long_text_of_many_names(spark):
    rng = random.Random(4)
    names = [f"{chr(65 + i % 26)}{''.join(rng.choice('aeiou') + rng.choice('lmnr') for _ in range(4))}" for i in range(400)]
    text = " ".join(f"Mr {rng.choice(names)} and {rng.choice(names)} met" for _ in range(60_000))
    df = spark.createDataFrame([(1, text), (2, "none here " * 200_000)], "__row long, text string")
    got = {r["__row"]: r for r in pii.pseudonymise(df, KEY, most_sent=-1).collect()}
    made = dict(zip(text.split(), got[1].text.split(), strict=True))
    assert got[1].n_entities == 120_000 and got[2].n_entities == 0
    assert len({made[n] for n in names}) == len(names) and not {made[n] for n in names} & set(names)
    assert [made[w] for w in text.split()] == got[1].text.split()


def test_session_key(spark):
    assert pii.session_key(spark) != pii.session_key(spark)
    spark.conf.set(pii.KEY_SETTING, "s")
    assert pii.session_key(spark) == b"s"
    spark.conf.unset(pii.KEY_SETTING)


def test_common_words_stay():
    text = "From: The Editor. Now the young met Mrs Young, as the editor said; Young people, The Editor"
    assert [(text[a:b], a) for a, b, _, _ in pii.find(text)] == [("The", 6), ("Editor", 10), ("Young", text.index("Young,"))]


def test_permutation_is_one():
    tool = pii.Surrogates(b"k")
    assert sorted(tool.permute("x", i, 1000) for i in range(1000)) == list(range(1000))
    cards = [f"{i:016d}" for i in range(0, 40000, 7)]
    made = [tool("card", c, 0, c) for c in cards]
    assert len(set(made)) == len(cards)
    assert [pii.luhn(c) == 0 for c in cards] == [pii.luhn(c) == 0 for c in made]


@pytest.mark.parametrize("sent", [pii.MOST_SENT, -1])
def test_collisions_are_drawn_again(spark, sent):
    names = [f"{chr(65 + i)}{chr(97 + j)}xen" for i in range(6) for j in range(6)]

    class Few(pii.Surrogates):
        """Draws from few surrogates, some of them real names."""

        def _formed(self, kind, value, draw):
            return (["Aaxen", "Bbxen"] + [f"Made{'abcdefghij'[k % 10]}" for k in range(30)])[self._stream(value, draw) % 32]

    docs = spark.createDataFrame([(i, f"Herr {n}") for i, n in enumerate(names * 2)], "doc_id long, text string")
    drawn = {r.value: r.draw for r in pii.redraws(pii.entities(docs), KEY, Few).collect()}
    assert drawn and max(drawn.values()) >= pii.LAST  # there are fewer surrogates than names
    texts = [r.text for r in pii.pseudonymise(docs, KEY, sent, Few).orderBy("doc_id").collect()]
    assert texts[: len(names)] == texts[len(names) :] and len(set(texts)) == len(names)
    assert not {t[5:] for t in texts} & set(names)


def passages(rng, n, least=15, most=59):
    words = ["".join(rng.choice(["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha"]) for _ in range(rng.randrange(1, 4))) for _ in range(800)]
    return [" ".join(rng.choice(words) for _ in range(rng.randrange(least, most))) + "." for _ in range(n)], words


def test_decontamination_finds_all(spark):
    rng = random.Random(8)
    items, words = passages(rng, 40)
    fill = lambda n: " ".join(rng.choice(words) for _ in range(n))
    docs, planted = [], set()
    for i in range(200):
        parts = [fill(rng.randrange(1, 300))]
        if i % 4 == 0:
            k = rng.randrange(40)
            text = items[k].upper() if i % 8 == 0 else items[k].replace(" ", "\n")
            parts += [text, fill(rng.randrange(1, 200))]
            planted.add((i, k))
        docs.append((i, " ".join(parts), "x"))
    # a paraphrase: some words left out, some put in
    w = items[3].split()
    docs.append((500, fill(50) + " " + " ".join(x if j % 8 else x + " also" for j, x in enumerate(w) if j % 11) + " " + fill(50), "x"))
    docs += [(600, None, "x"), (601, "", "x"), (602, "!!", "x"), (603, (fill(40) + " ") * 1200 + items[5], "x"), (None, items[7], "x")]
    planted |= {(500, 3), (603, 5), (None, 7)}
    df = spark.createDataFrame(docs, "doc_id long, text string, item_id string")
    bench = spark.createDataFrame([(k, t) for k, t in enumerate(items)] + [(98, None), (99, "")], "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontam.contaminated(df, bench).collect()}
    # brute force on words for what stands word by word
    flat = {d: " ".join(x.decode() for x in decontam.words_of(t)) for d, t, _ in docs}
    exact = {(d, k) for d, t in flat.items() for k, x in enumerate(items) if " ".join(y.decode() for y in decontam.words_of(x)) in t}
    assert exact <= planted and len(planted & found) >= 0.95 * len(planted)
    assert (500, 3) in found and (603, 5) in found
    assert not found - planted
    clean = decontam.keep_clean(df, bench)
    assert clean.columns == df.columns and {r.doc_id for r in clean.collect()} == {d for d, _, _ in docs} - {d for d, _ in found}
    blocks = {(r.doc_id, r.item_id) for r in decontam.contaminated(df, bench, most_bytes=7000).collect()}
    assert blocks == found
    again = decontam.contaminated(df.union(df), bench.union(bench.selectExpr("item_id + 1000", "text"))).collect()
    assert len(again) == 4 * len(found) and {(r.doc_id, r.item_id % 1000) for r in again} == found


def test_clean_rows_without_a_shuffle(spark):
    """Rows are judged where they stand, whatever their number: repeated, without an id, or with an id of a leaking row."""
    rng = random.Random(31)
    items, words = passages(rng, 30)
    fill = lambda n: " ".join(rng.choice(words) for _ in range(n))
    docs, want = [], []
    for i in range(90):
        text = f"{fill(60)} {items[i % 30]} {fill(60)}" if i % 3 == 0 else None if i == 1 else "" if i == 2 else fill(150)
        rows = [((i // 3 if i % 5 else None), text, [i])] * (2 if i % 4 == 0 else 1)
        docs += rows
        want += [] if i % 3 == 0 else rows
    df = spark.createDataFrame(docs, "doc_id long, text string, text_parts array<int>")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    order = lambda rows: sorted(map(repr, rows))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for most_bytes in (decontam.MOST_BYTES, 4000):
            clean = decontam.keep_clean(df, bench, most_bytes)
            assert clean.schema == df.schema and order(map(tuple, clean.collect())) == order(want)
            plan = clean._jdf.queryExecution().executedPlan().toString()
            assert "Exchange" not in plan and "Join" not in plan
        assert decontam.keep_clean(df, bench.limit(0)).count() == len(docs)
        assert decontam.keep_clean(df.limit(0), bench).count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_blocks_leave_the_callers_table(spark):
    """A staged table that is given stays when the searches of several blocks drop their own."""
    rng = random.Random(32)
    items, _ = passages(rng, 30)
    df = common.stage(spark.createDataFrame([(k, x) for k, x in enumerate(items)] + [(50, "quite another text")], "doc_id long, text string"), "given")
    clean = decontam.keep_clean(df, spark.createDataFrame(list(enumerate(items)), "item_id long, text string"), 2000)
    assert [r.doc_id for r in clean.collect()] == [50] and df.count() == 31


def test_long_words_and_pieces():
    rng = random.Random(1)
    text = " ".join("".join(rng.choice("abcé") for _ in range(rng.randrange(1, 9))) for _ in range(600_000))
    data = decontam.folded(text)
    assert len(data) > 3 * decontam._ROOM
    one = {w: int(decontam.hashes_of(w)[0]) for w in set(decontam.words_of(text))}
    assert decontam.hashes_of(data).tolist() == [one[w] for w in decontam.words_of(text)]
    assert len(decontam.hashes_of(b"")) == 0 and len(decontam.hashes_of(b"a" * (5 << 20))) == 5


def test_candidates_hold_words_of_the_item():
    """Windows that repeat a few words of an item are no candidates; all that have three fifths of it in order are."""
    rng = random.Random(41)
    items, words = passages(rng, 40, 10, 60)
    space = decontam.Space(np.random.default_rng(3).standard_normal((decontam.BUCKETS, 20)).astype(np.float32))
    searcher = lambda: decontam.Searcher(space, [decontam.Item(str(k), decontam.folded(x), decontam.folded(x)) for k, x in enumerate(items)])
    few = [" ".join(rng.choice(x.split()[:4]) for _ in range(300)) for x in items]
    assert not list(searcher().candidates([decontam.buckets_of(decontam.folded(x)) for x in few]))
    assert not list(decontam.Searcher(space, []).search(items))

    # items that repeat their words too
    items += [" ".join(x.split()[:7] * k) for x, k in zip(items[:8], (2, 3, 4, 8) * 2, strict=True)]
    tool = searcher()
    fill = lambda n: [rng.choice(words) for _ in range(n)]
    rows = []
    for k, x in enumerate(items):
        part = [w for w in x.split() if rng.random() > 0.2]
        rows.append(decontam.buckets_of(decontam.folded(" ".join(fill(k) + part + fill(rng.randrange(30))))))
    got = {x[:3] for x in tool.candidates(rows)}
    want = set()
    for r, b in enumerate(rows):
        for i, size in enumerate(tool.sizes.tolist()):
            w = next(w for w in decontam.WINDOWS if size <= w)
            item = space.place_of(decontam.buckets_of(tool.items[i].text))
            for first in range(0, len(b), w // 4):
                around = b[max(0, first - w // 4) : first + w + w // 4].tolist()
                near = space.place_of(b[first : first + w]) @ item > decontam.COSINE + 1e-4
                if near and decontam.lcs(tool.hashed(i), size, around) >= decontam.PARAPHRASE * size:
                    want.add((r, first, i))
    assert len({r for r, _, i in want if r == i}) > 40 and want <= got


def test_tails_of_long_items(spark):
    """The last words of a long item, by cosine alone: no four words in a row are left."""
    rng = random.Random(21)
    items, words = passages(rng, 30, 70, 76)
    fill = lambda n: " ".join(rng.choice(words) for _ in range(n))
    docs = []
    for k, x in enumerate(items):
        w = [y if j % 4 != 3 else rng.choice(words) for j, y in enumerate(x.split())]
        docs.append((k, f"{fill(80)} {' '.join(w)} {fill(80)}"))
    got = {(r.doc_id, r.item_id) for r in decontam.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(k, x, " ".join(x.split()[:3])) for k, x in enumerate(items)], "item_id long, text string, answer string")).collect()}
    assert got <= {(k, k) for k in range(30)} and len(got) >= 27


@pytest.mark.parametrize("share, least", [(0.2, 0.95), (0.3, 0.9)])
def test_paraphrase_recall(spark, share, least):
    """Items of which a share of the words is replaced, but not the answer; compared with the check on every place."""
    rng = random.Random(int(share * 100))
    items, words = passages(rng, 150, 20, 59)
    fill = lambda n: " ".join(rng.choice(words) for _ in range(n))
    rows, answers = [], [" ".join(x.split()[-4:]) for x in items]
    for k, x in enumerate(items):
        w = x.split()
        changed = [y if j >= len(w) - 4 or rng.random() > share else rng.choice(words) for j, y in enumerate(w)]
        rows.append((k, f"{fill(rng.randrange(20, 200))} {' '.join(changed)} {fill(rng.randrange(20, 200))}"))
    bench = spark.createDataFrame(list(zip(range(150), items, answers, strict=True)), "item_id long, text string, answer string")
    got = {(r.doc_id, r.item_id) for r in decontam.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()}
    want = set()
    for k, t in rows:
        w, item = decontam.words_of(t), decontam.words_of(items[k])
        if decontam.lcs(decontam.masks_of(item), len(item), w) >= decontam.PARAPHRASE * len(item):
            want.add((k, k))
    print(f"share {share}: {len(got & want)} of {len(want)} paraphrases, {len(got - want)} others")
    assert len(got & want) >= least * len(want) and len(got - want) <= 3


def test_decontamination_of_nothing(spark):
    df = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert decontam.contaminated(df.limit(0), bench).count() == 0
    assert decontam.contaminated(df, bench.limit(0)).count() == 0
    assert decontam.contaminated(df, bench).count() == 1


def test_lcs():
    rng = random.Random(9)
    for _ in range(200):
        a, b = ([rng.choice("abcd") for _ in range(rng.randrange(1, 20))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert decontam.lcs(decontam.masks_of(a), len(a), b) == table[-1][-1]


def test_pipeline(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    bench = spark.read.parquet(f"{sf}/benchmark.parquet")
    from tripleloom.llm.common import stage
    from tests.llm.test_simhash import brute, slow

    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "decontamination", "personal_data", "tokens"]
    steps = dict(corpus_pipeline.STAGES)
    one = stage(steps["language"](spark, docs, sf), "t1")
    texts = {r.doc_id: r.text for r in one.collect()}
    assert one.columns == docs.columns and len(texts) >= 0.98 * docs.count()
    two = stage(steps["near_duplicates"](spark, one, sf), "t2")
    groups = brute(list(texts), [slow(t) for t in texts.values()])
    assert {r.doc_id for r in two.collect()} == set(groups.values())
    three = stage(steps["decontamination"](spark, two, sf), "t3")
    flat = lambda t: " " + " ".join(x.decode() for x in decontam.words_of(t)) + " "
    items = [flat(r.text) for r in bench.collect()]
    dirty = {r.doc_id for r in two.collect() if any(i in flat(r.text) for i in items)}
    assert {r.doc_id for r in two.collect()} - {r.doc_id for r in three.collect()} >= dirty
    four = stage(steps["personal_data"](spark, three, sf), "t4")
    assert four.columns == docs.columns and four.count() == three.count()
    for r in four.join(three.withColumnRenamed("text", "before").select("doc_id", "before"), "doc_id").collect():
        found = pii.find(r.before)
        assert (r.text == r.before) == (not found) and r.n_chars == len(r.text)
        assert not any(r.before[a:b] in r.text for a, b, _, _ in found)
    assert steps["tokens"](spark, four, sf).count() == four.count() == corpus_pipeline.run(spark, sf).count()


def pipeline_folder(path, spark, rows, columns):
    spark.createDataFrame(rows, columns).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lamda mu")], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def test_pipeline_on_odd_rows(spark, tmp_path):
    """Nulls in every column, repeated and null ids, equal rows, a long text, columns with names that stages use inside."""
    rng = random.Random(3)
    words = {"en": [f"the{c}ing" for c in "abcdefghijklmnop"], "de": [f"sch{c}keit" for c in "abcdefghijklmnop"]}
    prose = lambda lang, n: " ".join(rng.choice(words[lang]) + rng.choice("aeiou") for _ in range(n))
    rows = [(i, prose(lang, 40), lang, "s", 1, "k", "x") for i, lang in enumerate(["en", "de"] * 60)]
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lamda mu"
    odd = [(None, prose("en", 50), None, None, None, None, None), (None, prose("de", 50), "de", "s", 1, "k", "x"), (7, prose("en", 60), "en", "s", 1, "k", "x")]
    dirty = (7, f"{prose('en', 30)} {item} {prose('en', 30)}", "en", "s", 1, "k", "x")
    secret = (500, f"{prose('en', 40)} password = hunter2xyz {prose('en', 40)}", "en", "s", 1, "k", "x")
    long = (501, prose("de", 120_000), "de", "s", 1, "k", "x")
    gone = [(600, None, "en", "s", 1, "k", "x"), (601, "", None, "s", 1, "k", "x"), (602, "123 !", "en", "s", 1, "k", "x")]
    every = [*rows, *odd, odd[2], rows[3], dirty, secret, long, *gone]
    columns = "doc_id long, text string, lang string, source string, n_chars long, __key string, lang_pred string"
    sf = pipeline_folder(tmp_path, spark, every, columns)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, step in corpus_pipeline.STAGES[:-1]:
        docs = step(spark, docs, sf)
        assert docs.columns == [c.split()[0] for c in columns.split(", ")], name
        from tripleloom.llm.common import stage

        docs = stage(docs, name)
    got = docs.collect()
    want = [*rows, *odd, long]
    texts = sorted(r.text for r in got if r.doc_id != 500)
    assert texts == sorted(x[1] for x in want) and {r.lang_pred for r in got} == {"x", None}
    assert sum(r.doc_id == 7 for r in got) == 2 and sum(r.doc_id is None for r in got) == 2
    hidden = next(r for r in got if r.doc_id == 500)
    assert "hunter2xyz" not in hidden.text and hidden.n_chars == len(hidden.text)
    assert corpus_pipeline.run(spark, sf).count() == len(got)


def test_pipeline_of_nothing(spark, tmp_path):
    sf = pipeline_folder(tmp_path, spark, [], "doc_id long, text string, lang string, source string, n_chars long")
    assert corpus_pipeline.run(spark, sf).count() == 0


def test_decontamination_among_repeated_words(spark):
    rng = random.Random(12)
    items, words = passages(rng, 60, 3, 20)
    fill = lambda n: " ".join(rng.choice(words) for _ in range(n))
    docs = [(1000 + k, fill(200)) for k in range(300)]
    for k, x in enumerate(items):
        w = rng.choice(words)
        docs += [(2 * k, f"{f'{w} ' * 60}{x} {f'{w} ' * 60}"), (2 * k + 1, f"{fill(100)} {x} {fill(100)}")]
    got = {(r.doc_id, r.item_id) for r in decontam.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(list(enumerate(items)), "item_id long, text string")).collect()}
    missing = {(2 * k + j, k) for k in range(60) for j in range(2)} - got
    assert not missing
