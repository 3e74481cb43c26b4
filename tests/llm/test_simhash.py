import random

import numpy as np
import pytest
import xxhash

from tripleloom.llm import common, simhash


def slow(text, width=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute(ids, fps, budget=3):
    group = list(range(len(fps)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= budget:
                group[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return {d: least.get(find(i)) for i, d in enumerate(ids)}


TEXTS = [None, "", " \n", "one", "one two", "A b C", "a B c", "x\x0by z w", "Ä b c", "a  b\tc", "w " * 5000]


def test_fingerprint():
    for t in [*TEXTS, "the quick brown fox jumps over the lazy dog " * 3]:
        assert simhash.fingerprint(t.encode() if t is not None else None) == slow(t)


@pytest.mark.parametrize("seed", range(5))
def test_trie_against_all_pairs(seed):
    rng = random.Random(seed)
    keys = set()
    for _ in range(60):
        base = rng.getrandbits(64)
        for _ in range(8):
            x = base
            for _ in range(rng.randrange(5)):
                x ^= 1 << rng.randrange(48)
            keys.add(x)
    keys = np.array(sorted(keys), np.uint64)
    _, task = np.unique(keys >> np.uint64(48), return_inverse=True)
    label = simhash.trie_links(task, keys, 3)
    want = simhash._merge(np.arange(len(keys)), *np.nonzero((np.bitwise_count(keys[:, None] ^ keys) <= 3) & (task[:, None] == task)))
    pairs = lambda x: {frozenset(np.flatnonzero(x == v).tolist()) for v in set(x.tolist())}
    assert pairs(label) == pairs(want)


def test_trie_dense_and_empty():
    assert len(simhash.trie_links(np.zeros(0, int), np.zeros(0, np.uint64), 3)) == 0
    keys = np.array([(1 << a) | (1 << b) for a in range(48) for b in range(48)], np.uint64)
    assert len(set(simhash.trie_links(np.zeros(len(keys), int), keys, 3).tolist())) == 1


@pytest.mark.parametrize("seed", range(3))
def test_pairs_of_subtrees(seed):
    """Links between the two sides of a task only."""
    rng = random.Random(seed)
    low = sorted({rng.getrandbits(9) << 2 for _ in range(80)})
    keys = np.array(low + [x | 1 << 20 for x in low], np.uint64)
    side = np.array([simhash.FIRST] * len(low) + [simhash.SECOND] * len(low))
    label = simhash.trie_links(np.zeros(len(keys), int), keys, 3, side)
    near = np.bitwise_count(keys[:, None] ^ keys) <= 3
    want = simhash._merge(np.arange(len(keys)), *np.nonzero(near & (side[:, None] < side)))
    pairs = lambda x: {frozenset(np.flatnonzero(x == v).tolist()) for v in set(x.tolist())}
    assert pairs(label) == pairs(want)
    alone = simhash.trie_links(np.zeros(len(low), int), keys[: len(low)], 3, side[: len(low)])
    assert len(set(alone.tolist())) == len(low)


def test_subtrees_are_cut_without_a_collect(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    rng = random.Random(5)
    keys = sorted({(rng.getrandbits(6) << 40 | rng.getrandbits(5) << 20 | rng.getrandbits(4)) - (1 << 62) for _ in range(120)})
    fps = spark.createDataFrame([(k,) for k in keys], "fp long")
    with monkeypatch.context() as m:
        m.setattr(DataFrame, "collect", lambda self: pytest.fail("collected"))
        m.setattr(DataFrame, "toPandas", lambda self: pytest.fail("collected"))
        edges = simhash.links(fps, subtree_rows=3)
    at = {k: i for i, k in enumerate(keys)}
    got = [(at[r.a], at[r.b]) for r in edges.collect()]
    merged = simhash._merge(np.arange(len(keys)), *(np.array(x) for x in zip(*got, strict=True)))
    u = np.array(keys, np.int64).view(np.uint64)
    want = simhash._merge(np.arange(len(keys)), *np.nonzero(np.bitwise_count(u[:, None] ^ u) <= 3))
    assert merged.tolist() == want.tolist()


@pytest.fixture(scope="module")
def documents(spark):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(300)]
    rows, i = [], 0
    for _ in range(40):
        base = [rng.choice(words) for _ in range(rng.randrange(1, 120))]
        for _ in range(rng.randrange(1, 6)):
            t = list(base)
            if len(t) > 5 and rng.random() < 0.7:
                t[rng.randrange(len(t))] = rng.choice(words)
            rows.append((i, " ".join(t)))
            i += 1
    rows += [(1000 + k, t) for k, t in enumerate(TEXTS)] + [(None, "one two"), (5, rows[5][1])]
    return rows


@pytest.mark.parametrize("cut", [simhash.SUBTREE_ROWS, 3])
def test_near_duplicates(spark, documents, cut):
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in documents], "doc_id long, text string, fingerprint string, __first int")
    got = simhash.near_duplicates(df, subtree_rows=cut).collect()
    fps = [slow(t) for _, t in documents]
    want = brute([d for d, _ in documents], fps)
    assert len(got) == len(documents)
    for r in got:
        if r.doc_id is not None:
            assert r.component_id == want[r.doc_id]
    assert sorted(r.fingerprint for r in got) == sorted(f"{x:016x}" for x in fps)
    kept = simhash.keep_first(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()) - {None})


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(df).count() == 0


def test_components_of_paths_and_hubs(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (200, 199), (200, 199)]
    got = {r.v: r.root for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)} | {199: 199, 200: 199}


def test_keep_first_keeps_a_row_of_every_component(spark):
    texts = [" ".join(f"w{k * 50 + j}" for j in range(40)) for k in range(6)]
    rows = [(None, texts[0], "x"), (None, texts[1], "x"), (None, texts[2], "x"), (7, texts[3], "x"), (7, texts[4], "y"), (None, texts[3], "x"), (8, texts[5], "a"), (8, texts[5], "a"), (8, texts[5], "b")]
    got = simhash.keep_first(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert got.columns == ["doc_id", "text", "lang"]
    assert sorted((r.text, r.doc_id or 0) for r in got.collect()) == sorted(zip(texts, [0, 0, 0, 7, 7, 8], strict=True))
