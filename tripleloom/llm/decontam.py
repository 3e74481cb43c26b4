"""Benchmark decontamination by latent semantic retrieval.

Words are hashed to buckets and weighted by TF-IDF. A randomised SVD of the matrix of all passages
gives a latent space: every task multiplies its passages' counts by a fixed random matrix and back,
and counts document frequencies beside it; sums are added up in Spark, and the small rest is solved
on the driver by the Nystroem formula. That formula holds for any probe, so the frequencies, known
only after the pass, may scale the probe and its image afterwards. In that space, scaled to unit variance, windows of every document are compared
with the benchmark's items by cosine. Further candidates stand where a text and an item have
a few words in a row in common, so that what repeated words around it hide from the cosine is found too. Candidates are then checked on their words: longest common
subsequence with the item, and, for paraphrases, with the item's answer.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_stage, prepare, stage

#: Buckets for words, dimensions of the latent space, further columns of the sketch.
BUCKETS, DIMENSIONS, SPARE = 1 << 12, 84, 12
#: Words of a window by the length of items; longer items are searched in parts.
WINDOWS = (16, 32, 64)
#: Least cosine of a candidate, least common subsequence of a copy, and of a paraphrase and its answer.
COSINE, COPY, PARAPHRASE, ANSWER = 0.4, 0.8, 0.6, 0.8
#: Items under so many words must occur word by word; longer ones are also looked for by so many words in a row.
SHORT, GRAM = 8, 4
#: Words of passages that the space is made from; words that are handled at once.
PASSAGE, PART = 64, 10_000
#: Bits for the buckets of an item or a window.
BITS = 1 << 10
#: Bytes of items that are sent to executors at once; more go in several searches. Items that are compared at once.
MOST_BYTES, BLOCK_ITEMS = 16 << 20, 2048
#: Letters of words: digits, letters, the underscore, and all that is not ASCII but this punctuation.
_WORD = re.compile(rb"[0-9a-z_\x80-\xff]+")
_MARKS = re.compile("[\u00a0-\u00a9\u00ab-\u00b4\u00b6-\u00b9\u00bb\u00bf\u2000-\u206f\u3000-\u303f]")
_IN_WORD = bytes(c in b"0123456789abcdefghijklmnopqrstuvwxyz_" or c >= 128 for c in range(256))
_MULTIPLIER = 0x9E3779B97F4A7C15


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_ROOM = 1 << 20
_UP, _DOWN = _powers(_MULTIPLIER, _ROOM), _powers(pow(_MULTIPLIER, -1, 1 << 64), _ROOM)


def folded(text: str | None) -> bytes:
    """The text in lower case, without punctuation that is not ASCII, as UTF-8."""
    if not text:
        return b""
    low = text.lower()
    return (low if low.isascii() else _MARKS.sub(" ", low)).encode("utf-8", "replace")


def words_of(text: str | None) -> list[bytes]:
    return _WORD.findall(folded(text))


def hashes_of(data: bytes) -> np.ndarray:
    """A 64-bit hash of every word of a folded text, by polynomial hashes from prefix sums.

    Long texts are taken in pieces that end between words; a word of over a MiB counts as several.
    """
    out, at = [], 0
    while True:
        a = np.frombuffer(data, np.uint8, min(len(data) - at, _ROOM), at) if at < len(data) else np.zeros(0, np.uint8)
        inside = np.zeros(len(a) + 2, bool)
        inside[1:-1] = np.frombuffer(a.tobytes().translate(_IN_WORD), bool)
        if at + len(a) < len(data) and len(gaps := np.flatnonzero(~inside[1:-1])):
            a, inside = a[: gaps[-1] + 1], inside[: gaps[-1] + 3]
            inside[-1] = False
        edge = np.flatnonzero(inside[1:] != inside[:-1])
        start, end = edge[0::2], edge[1::2]
        total = np.zeros(len(a) + 1, np.uint64)
        value = a.astype(np.uint64)
        value += np.uint64(1)
        value *= _DOWN[: len(a)]
        np.cumsum(value, out=total[1:])
        h = (total[end] - total[start]) * _UP[start]
        out.append((h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9))
        at += len(a)
        if at >= len(data):
            return out[0] if len(out) == 1 else np.concatenate(out)


def buckets_of(data: bytes) -> np.ndarray:
    """The bucket of every word of a folded text."""
    return (hashes_of(data) >> np.uint64(52)).astype(np.int64)


def grams(h: np.ndarray, size: int) -> np.ndarray:
    """A hash of every ``size`` words in a row of a text's word hashes."""
    n = max(0, len(h) - size + 1)
    out = h[:n].copy()
    for k in range(1, size):
        out = (out ^ (out >> np.uint64(29))) * np.uint64(_MULTIPLIER) + h[k : n + k]
    return out


def lcs(masks: dict, size: int, words: list) -> int:
    """Length of the longest common subsequence, by bits; ``masks`` has the places of each word of one side."""
    row = (1 << size) - 1
    full = row
    for w in words:
        if m := masks.get(w):
            x = row & m
            row = ((row + x) | (row - x)) & full
    return size - row.bit_count()


def masks_of(words: list) -> dict:
    out: dict = {}
    for i, w in enumerate(words):
        out[w] = out.get(w, 0) | 1 << i
    return out


@dataclass
class Space:
    """``project[b]`` is the place of a word of bucket b: TF-IDF weight, singular vectors, unit variance."""

    project: np.ndarray

    def place(self, words: list[bytes]) -> np.ndarray:
        return self.place_of(buckets_of(b" ".join(words)))

    def place_of(self, buckets: np.ndarray) -> np.ndarray:
        v = self.project[buckets].sum(axis=0)
        return v / (np.linalg.norm(v) or 1)


def _parts(rows: list[np.ndarray], most: int = PART) -> Iterator[np.ndarray]:
    """Bucket arrays of several texts, each padded to whole passages by BUCKETS, about ``most`` words at once."""
    held, size = [], 0
    for b in rows:
        for at in range(0, len(b), most):
            cut = b[at : at + most]
            held.append(np.append(cut, np.full(-len(cut) % PASSAGE, BUCKETS)))
            size += len(held[-1])
            if size >= most:
                yield np.concatenate(held)
                held, size = [], 0
    if held:
        yield np.concatenate(held)


def _added(project: np.ndarray, line: np.ndarray, step: int) -> np.ndarray:
    """Sums of ``project`` over every ``step`` words of a line that is a multiple of them long."""
    out = project[line[0::step]]
    for k in range(1, step):
        out += np.take(project, line[k::step], axis=0)
    return out


def _bits(line: np.ndarray, step: int) -> np.ndarray:
    """Bits for the buckets, modulo BITS, in every ``step`` words of a line that is a multiple of them long.

    BUCKETS, which pads, counts as bucket 0: that may let a window through, but leaves none out.
    """
    out = np.zeros((len(line) // step, BITS // 64), np.uint64)
    row = np.arange(len(out))
    one = np.uint64(1) << (line & 63).astype(np.uint64)
    word = line >> 6 & BITS // 64 - 1
    for k in range(step):
        out[row, word[k::step]] |= one[k::step]
    return out


def latent_space(docs: DataFrame) -> Space:
    """The space of all passages of ``docs(text)``; without words, every place is zero."""
    width = DIMENSIONS + SPARE
    probe = np.random.default_rng(11).standard_normal((BUCKETS + 1, width)).astype(np.float32)
    probe[BUCKETS] = 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        image, df, n = np.zeros((BUCKETS + 1, width)), np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            rows = [buckets_of(folded(t)) for t in batch.column(0).to_pylist()]
            n += len(rows)
            for b in rows:
                df += np.bincount(b, minlength=BUCKETS) > 0
            for b in _parts(rows):
                count = len(b) // PASSAGE
                # columns for the buckets that occur, the last one is for padding
                here = np.zeros(BUCKETS + 1, bool)
                here[b] = here[BUCKETS] = True
                some = np.flatnonzero(here)
                column = np.cumsum(here) - 1
                table = np.zeros((count, len(some)), np.float32)
                np.add.at(table.reshape(-1), np.repeat(np.arange(count) * len(some), PASSAGE) + column[b], np.float32(1))
                y = _added(probe, b, PASSAGE)
                y /= np.maximum(PASSAGE - table[:, -1:], 1)
                image[some] += table.T @ y
        values = [pa.array(image[:BUCKETS, j]) for j in range(width)]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BUCKETS)), pa.array(df), pa.array(np.full(BUCKETS, n)), *values], names)

    columns = [f"v{j}" for j in range(width)]
    names = ["bucket", "df", "n", *columns]
    shape = "bucket long, df long, n long, " + ", ".join(f"{c} double" for c in columns)
    sums = docs.select("text").mapInArrow(run, shape).groupBy("bucket").agg(*[F.sum(c).alias(c) for c in names[1:]])
    z, df, n = np.zeros((BUCKETS, width)), np.zeros(BUCKETS), 0
    for x in sums.collect():
        df[x[0]], n, z[x[0]] = x[1], x[2], x[3:]
    idf = np.where(df > 0, np.log((1 + n) / (1 + df)) + 1, 0.0)
    core = probe[:BUCKETS].T.astype(np.float64) @ z
    z *= idf[:, None]
    value, vector = np.linalg.eigh((core + core.T) / 2)
    sound = value > max(value.max(), 0) * 1e-9
    if not sound.any():
        return Space(np.zeros((BUCKETS, 1), np.float32))
    u, s, _ = np.linalg.svd(z @ (vector[:, sound] / np.sqrt(value[sound])), full_matrices=False)
    keep = min(DIMENSIONS, int((s > s[0] * 1e-6).sum()))
    return Space((idf[:, None] * u[:, :keep] / s[:keep]).astype(np.float32))


@dataclass
class Item:
    """An item's folded text, and that of its answer, the last sentence if there is none."""

    key: str
    text: bytes
    answer: bytes


def items_of(rows: list) -> list[Item]:
    """Items from (key, text[, answer]) rows that have a word."""
    out = []
    for x in rows:
        if len(hashes_of(text := folded(x.text))):
            answer = folded(getattr(x, "answer", None))
            if not len(hashes_of(answer)):
                answer = [w for w in map(folded, re.split(r"[.!?]+(?:\s|$)", x.text)) if _WORD.search(w)][-1]
            out.append(Item(x.key, text, answer))
    return out


class Searcher:
    """Windows of documents against the items."""

    def __init__(self, space: Space, items: list[Item]) -> None:
        self.space, self.items = space, items
        self.project = np.vstack([space.project, np.zeros((1, space.project.shape[1]), np.float32)])
        hashes = [hashes_of(x.text) for x in items]
        self.sizes = np.array(list(map(len, hashes)))
        # words and places are made for the items that are candidates; of all, bits for their buckets
        self.words = lru_cache(1 << 12)(lambda i: _WORD.findall(items[i].text))
        self.masks = lru_cache(1 << 12)(lambda i: masks_of(self.words(i)))
        self.answers = lru_cache(1 << 12)(lambda i: (masks_of(a := _WORD.findall(items[i].answer)), len(a)))
        self.hashed = lru_cache(1 << 12)(lambda i: masks_of(buckets_of(items[i].text).tolist()))
        self.bits = np.array([np.bitwise_or.reduce(_bits((h >> np.uint64(52)).astype(np.int64), 1)) for h in hashes], np.uint64).reshape(-1, BITS // 64)
        # bits that a text must have in common with an item, of which some words may share one
        self.least = PARAPHRASE * self.sizes - (self.sizes - np.bitwise_count(self.bits).sum(axis=1, dtype=np.int64))
        found: dict[int, list[tuple[np.ndarray, int]]] = {}
        self.queries = {w: ([], []) for w in WINDOWS}
        for i, h in enumerate(hashes):
            size = min(len(h), GRAM if len(h) >= SHORT else SHORT)
            found.setdefault(size, []).append((grams(h, size), i))
            # the last part of a long item ends with it
            for at in sorted({min(at, max(0, len(h) - WINDOWS[-1])) for at in range(0, len(h), WINDOWS[-1])}):
                part = h[at : at + WINDOWS[-1]]
                w = next(w for w in WINDOWS if len(part) <= w)
                self.queries[w][0].append((i, at))
                self.queries[w][1].append(space.place_of((part >> np.uint64(52)).astype(np.int64)))
        self.queries = {w: (np.array(places, np.int64).reshape(-1, 2), np.array(vectors, np.float32)) for w, (places, vectors) in self.queries.items()}
        self.exact = []
        for size, parts in found.items():
            known = np.concatenate([g for g, _ in parts])
            item = np.repeat([i for _, i in parts], [len(g) for g, _ in parts])
            place = np.concatenate([np.arange(len(g)) for g, _ in parts])
            order = np.argsort(known, kind="stable")
            sieve = np.zeros(1 << 20, bool)
            sieve[known >> np.uint64(44)] = True
            self.exact.append((size, known[order], item[order], place[order], sieve))

    def shared(self, i: np.ndarray, bits: np.ndarray) -> np.ndarray:
        """How many bits items of at most 64 words have in common with rows of bits."""
        # no byte gets over 64 by adding, as all counts of a row together are no more
        count = np.bitwise_count(self.bits[i] & bits).view(np.uint64).sum(axis=1)
        return (count * np.uint64(0x0101010101010101) >> np.uint64(56)).astype(np.int64)

    def region(self, first: int, i: int, place: int) -> tuple[int, int]:
        """Words of a document that are compared with an item of which the part at ``place`` is near ``first``."""
        size = int(self.sizes[i])
        window = next((w for w in WINDOWS if size - place <= w), WINDOWS[-1])
        return max(0, first - place - window // 4), first - place + max(size, window) + window // 4

    def candidates(self, rows: list[np.ndarray]) -> Iterator[tuple[int, int, int, int, float]]:
        """(row, window's first word, item, place in the item, cosine) of windows that are near an item.

        Windows are left out if fewer words of the item stand around them than a paraphrase has in common with it.
        """
        gap = WINDOWS[-1]
        padded = [np.append(b, np.full(gap + -len(b) % gap, BUCKETS)) for b in rows]
        begins = np.cumsum([0, *map(len, padded)])
        line = np.concatenate(padded)
        sums = None
        for w in WINDOWS:
            step = w // 4
            sums, bits = (_added(self.project, line, step), _bits(line, step)) if sums is None else (pairs[0::2], two[0::2])
            pairs, two = sums.copy(), bits.copy()
            pairs[:-1] += sums[1:]
            two[:-1] |= bits[1:]
            every, vectors = self.queries[w]
            if not len(every):
                continue
            total = pairs.copy()
            total[:-2] += pairs[2:]
            norm = np.maximum(np.sqrt(np.einsum("ij,ij->i", total, total)), 1e-6)
            # of a window and a step before and behind it
            around = np.concatenate((two[:1], two[:-1]))
            around[:-1] |= two[1:]
            around[:-3] |= two[3:]
            for first in range(0, len(every), BLOCK_ITEMS):
                places = every[first : first + BLOCK_ITEMS]
                near = total @ vectors[first : first + BLOCK_ITEMS].T
                at, q = np.divmod(np.flatnonzero(near >= COSINE * norm[:, None]), len(places))
                if not len(at):
                    continue
                which = places[q, 0]
                fits = self.sizes[which] > gap
                inner = np.flatnonzero(~fits)
                for s in range(0, len(inner), 1 << 12):
                    cut = inner[s : s + (1 << 12)]
                    fits[cut] = self.shared(which[cut], around[at[cut]]) >= self.least[which[cut]]
                at, q = at[fits], q[fits]
                row = np.searchsorted(begins, at * step, side="right") - 1
                for a, b, r in zip(at.tolist(), q.tolist(), row.tolist(), strict=True):
                    yield r, a * step - int(begins[r]), int(places[b, 0]), int(places[b, 1]), float(near[a, b] / norm[a])

    def in_a_row(self, h: np.ndarray) -> Iterator[tuple[int, int]]:
        """(first word, item) where the item would begin, by the words in a row that a text has in common with an item.

        Of short items, all of the words; of longer ones, one finding for each shift by a few words.
        """
        for size, known, item, places, sieve in self.exact:
            g = grams(h, size)
            seen = set()
            maybe = np.flatnonzero(sieve[g >> np.uint64(44)])
            begin, end = (np.searchsorted(known, g[maybe], side) for side in ("left", "right"))
            for at, a, b in zip(maybe.tolist(), begin.tolist(), end.tolist(), strict=True):
                for i, place in zip(item[a:b].tolist(), places[a:b].tolist(), strict=True):
                    # a text that repeats an item's words has them again in every window of it
                    key = (i, (at - place) // SHORT, at // WINDOWS[-1]) if self.sizes[i] >= SHORT else i
                    if key not in seen:
                        seen.add(key)
                        yield at - place, i

    def cosine(self, first: int, i: int, b: np.ndarray) -> float:
        """Cosine of a text's words from ``first`` on with the item, or its first part."""
        part = buckets_of(self.items[i].text)[: WINDOWS[-1]]
        v = self.space.project[b[first : first + len(part)]].sum(axis=0)
        return float(v @ self.space.place_of(part) / (np.linalg.norm(v) or 1))

    def check(self, words: list[bytes], first: int, i: int, place: int) -> tuple[float, float] | None:
        """Common subsequences with the item and its answer near a window, None if the text does not hold the item."""
        size = int(self.sizes[i])
        a, b = self.region(first, i, place)
        region = words[a:b]
        share = lcs(self.masks(i), size, region) / size
        if share < PARAPHRASE:
            return None
        masks, length = self.answers(i)
        answer = lcs(masks, length, region) / length
        if size < SHORT:
            return (share, answer) if any(region[k : k + size] == self.words(i) for k in range(len(region))) else None
        return (share, answer) if share >= COPY or answer >= ANSWER else None

    def search(self, texts: list[str | None]) -> Iterator[tuple[int, int, float, float, float, int]]:
        """(row, item, cosine, share, answer, first word): the best finding of each row and item."""
        best: dict[tuple[int, int], tuple] = {}
        overlap = int(self.sizes.max(initial=0)) + 2 * WINDOWS[-1]
        for held in self._held(texts, overlap):
            words: dict[int, list[bytes]] = {}
            for k, first, i, place, cosine in self._all([(h >> np.uint64(52)).astype(np.int64) for _, _, h in held], [x[2] for x in held]):
                row, base, h = held[k]
                old = best.get((row, i))
                if old and old[2] >= 1.0:
                    continue
                at, end = self.region(first, i, place)
                near = (h[at:end] >> np.uint64(52)).astype(np.int64)
                size = int(self.sizes[i])
                # equal words have equal buckets: what fails on buckets fails on words
                if lcs(self.hashed(i), size, near.tolist()) < PARAPHRASE * size:
                    continue
                if row not in words:
                    words[row] = words_of(texts[row])
                found = self.check(words[row], base + first, i, place)
                if found and (old is None or found[0] > old[2]):
                    if cosine is None:
                        first = max(0, first)
                        cosine = self.cosine(first, i, (h >> np.uint64(52)).astype(np.int64))
                    best[row, i] = (i, cosine, *found, base + first)
        for (row, _), x in best.items():
            yield row, *x

    def _all(self, rows: list[np.ndarray], hashes: list[np.ndarray]) -> Iterator[tuple[int, int, int, int, float | None]]:
        """Candidates by cosine, then those by words in a row, without a cosine."""
        yield from self.candidates(rows)
        for k, h in enumerate(hashes):
            for first, i in self.in_a_row(h):
                yield k, first, i, 0, None

    @staticmethod
    def _held(texts: list[str | None], overlap: int) -> Iterator[list[tuple[int, int, np.ndarray]]]:
        """(row, first word, hashes) of texts or their parts, about PART words at once."""
        held, size = [], 0
        for row, text in enumerate(texts):
            b = hashes_of(folded(text))
            for base in range(0, len(b), PART):
                held.append((row, base, b[base : base + PART + overlap]))
                size += len(held[-1][2])
                if size >= PART:
                    yield held
                    held, size = [], 0
        if held:
            yield held


def contaminated(docs: DataFrame, benchmark: DataFrame, most_bytes: int = MOST_BYTES) -> DataFrame:
    """(doc_id, item_id, cosine, lcs, answer, first_word): every document and item that it holds.

    ``lcs`` is the share of the item's words found in order, ``answer`` that of its answer: the
    column ``answer`` of benchmark, or the last sentence. Null and empty texts hold nothing, items
    without words are nowhere. Repeated documents and items are reported one by one: items of one
    text are searched once. Empty tables give an empty result; other columns are ignored. The corpus is
    read once for every ``most_bytes`` of items of different text, which is what is sent to executors.
    """
    spark = docs.sparkSession
    prepare(spark)
    rows, out = docs.select("doc_id", "text"), None
    known, blocks = _known(benchmark, most_bytes)
    ids = {"doc": rows.schema["doc_id"].dataType.simpleString(), "item": benchmark.schema["item_id"].dataType.simpleString()}
    if not blocks:
        return spark.createDataFrame([], f"doc_id {ids['doc']}, item_id {ids['item']}, cosine double, lcs double, answer double, first_word long")
    space = latent_space(rows)
    for part in blocks:
        found = _search(rows, space, items_of(part.orderBy("key").collect()), ids["doc"])
        out = found if out is None else out.unionByName(found)
    return out.join(known.select("key", "item_id"), "key").select("doc_id", "item_id", "cosine", "lcs", "answer", "first_word")


def _known(benchmark: DataFrame, most_bytes: int) -> tuple[DataFrame, list[DataFrame]]:
    """(key, item_id) of the items that have a text, and their different texts in blocks of about ``most_bytes``."""
    columns = [c for c in ("text", "answer") if c in benchmark.columns]
    key = F.sha2(F.concat_ws("\0", *[F.coalesce(F.sha2(c, 256), F.lit("-")) for c in columns]), 256)
    known = stage(benchmark.filter(F.col("text").isNotNull()).select("item_id", key.alias("key"), *columns), "items")
    texts = known.select("key", *columns).dropDuplicates(["key"])
    total = texts.agg(F.sum(sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in columns), F.lit(200))).alias("n")).first()["n"]
    blocks = -(-(total or 0) // most_bytes)
    return known, [texts.filter(F.pmod(F.xxhash64("key"), F.lit(blocks)) == k) if blocks > 1 else texts for k in range(blocks)]


def _search(rows: DataFrame, space: Space, items: list[Item], doc_type: str) -> DataFrame:
    """(doc_id, key, cosine, lcs, answer, first_word) for items of at most MOST_BYTES, as they were chosen."""
    sent = rows.sparkSession.sparkContext.broadcast((space, items))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space, items = sent.value
        tool = Searcher(space, items)
        for batch in batches:
            got = list(tool.search(batch.column(1).to_pylist()))
            doc = batch.column(0).take(pa.array([x[0] for x in got], pa.int64()))
            key = pa.array([items[x[1]].key for x in got], pa.string())
            rest = [pa.array([x[i] for x in got], pa.float64()) for i in (2, 3, 4)]
            yield pa.RecordBatch.from_arrays([doc, key, *rest, pa.array([x[5] for x in got], pa.int64())], ["doc_id", "key", "cosine", "lcs", "answer", "first_word"])

    return rows.mapInArrow(run, f"doc_id {doc_type}, key string, cosine double, lcs double, answer double, first_word long")


def _without(docs: DataFrame, space: Space, items: list[Item]) -> DataFrame:
    """docs without the rows whose text holds one of the items."""
    sent = docs.sparkSession.sparkContext.broadcast((space, items))
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = Searcher(*sent.value)
        for batch in batches:
            clean = np.ones(batch.num_rows, bool)
            clean[[x[0] for x in tool.search(batch.column(at).to_pylist())]] = False
            yield batch.filter(pa.array(clean))

    return docs.mapInArrow(run, docs.schema)


def keep_clean(docs: DataFrame, benchmark: DataFrame, most_bytes: int = MOST_BYTES) -> DataFrame:
    """docs without the rows whose text holds an item of the benchmark.

    Every row is judged by its own text where it stands, so ids may repeat or be null, and no text is shuffled.
    Rows of null or empty text stay. All columns are kept. If the items need several searches, each works
    on the rows that the one before left, which are staged between them.
    """
    prepare(docs.sparkSession)
    _, blocks = _known(benchmark, most_bytes)
    if not blocks:
        return docs
    space, left, own = latent_space(docs), docs, None
    for k, part in enumerate(blocks):
        if k:
            left = stage(left, "clean")
            if own is not None:
                drop_stage(own)
            own = left
        left = _without(left, space, items_of(part.orderBy("key").collect()))
    return left
