"""Removal of long byte strings that occur more than once, by longest-previous-factor arrays.

A suffix array over a whole corpus fits no machine, so the corpus is first cut into pieces that
can only repeat each other inside one group:

1. Every ``length``-byte window has an anchor, the least hash among its grams of a quarter of that.
   Equal windows have equal anchors at equal places. Consecutive windows with one anchor form a
   *run*; its bytes are its content. Equal contents are one row with their number.
2. Contents that are alone with their anchor repeat nowhere and are left out. The others are put
   in suffix order, group by group. Since equal windows have their anchors at equal places, only
   suffixes that start equally far before an anchor can share a factor of ``length`` bytes, so the order
   of each such family follows from the one before by a stable sort on one byte, and the common
   prefixes of neighbours by range minima.
3. A window goes if its longest factor elsewhere, or its longest previous factor where the first
   copy is to stay, has ``length`` bytes.

An anchor with many different contents, such as the edge of a passage that many documents share, would
be one large group. Its contents are cut into blocks of windows at fixed places around the
anchor, keyed by the bytes that all windows of the block have in common, and blocks that still are
large into single windows; then contents of a group that differ are few.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import prepare, shuffle_parts, stage

#: Bytes of contents that are put in one suffix order, and contents of a shuffled partition.
CHUNK_BYTES, PARTITION_ROWS = 1 << 22, 1 << 16
#: Different contents of a group beyond which it is cut, and windows of the blocks it is cut into, in turn.
MOST_CONTENTS, BLOCKS = 2000, (16, 1)
#: Windows of a very long text that are hashed at once.
SEGMENT = 1 << 20
#: Columns of contents, of the content that a block is from, and of flags.
CONTENT = {"key": pa.int64(), "digest": pa.binary(), "n": pa.int64(), "row": pa.int64(), "lo": pa.int64(), "at": pa.int64(), "bytes": pa.binary()}
PARENT = {"parent": pa.int64(), "parent_digest": pa.binary()}
FLAG = {"key": pa.int64(), "digest": pa.binary(), "again": pa.bool_(), "row": pa.int64(), "a": pa.int64(), "b": pa.int64()}
_MULTIPLIER = 0x9E3779B97F4A7C15 | 1


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.ones(n, np.uint64)
    out[1:] = np.uint64(base)
    return np.multiply.accumulate(out)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


class _Grams:
    """Rolling hashes of all ``size``-byte grams: prefix sums of byte * base**-i, scaled back."""

    def __init__(self, size: int) -> None:
        self.size, self.room = size, 0
        self.up = self.down = np.zeros(0, np.uint64)

    def __call__(self, data: np.ndarray) -> np.ndarray:
        n = len(data)
        if n > self.room:
            self.room = max(n, 1 << 16)
            self.up = _powers(_MULTIPLIER, self.room)
            self.down = _powers(pow(_MULTIPLIER, -1, 1 << 64), self.room)
        total = np.empty(n + 1, np.uint64)
        total[0] = 0
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.down[:n], out=total[1:])
        count = n - self.size + 1
        return _mixed((total[self.size :] - total[:count]) * self.up[:count])


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w consecutive values, by prefix and suffix minima of blocks of w."""
    n = len(x)
    pad = -n % w
    blocks = np.append(x, np.full(pad, np.iinfo(x.dtype).max, x.dtype)).reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - w + 1], ahead[w - 1 : n])


def runs(data: memoryview, length: int, grams: _Grams) -> Iterator[tuple[np.ndarray, ...]]:
    """(anchor hash, its place, first window, last window) of the runs of a text, in parts."""
    whole = np.frombuffer(data, np.uint8)
    windows, w = len(whole) - length + 1, length - grams.size + 1
    for at in range(0, windows, SEGMENT):
        count = min(SEGMENT, windows - at)
        h = grams(whole[at : at + count + length - 1])
        place = np.uint64((1 << 24) - 1)
        least = _sliding_min((h & ~place) | np.arange(len(h), dtype=np.uint64), w) & place
        first = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
        anchor = least[first].astype(np.int64)
        yield h[anchor].view(np.int64), at + anchor, at + first, at + np.append(first[1:], count) - 1


def _digest(data: bytes | memoryview) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def _batch(rows: list[tuple], columns: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[i] for x in rows], kind) for i, kind in enumerate(columns.values())], list(columns))


def _shape(columns: dict[str, pa.DataType]) -> str:
    names = {pa.int64(): "long", pa.binary(): "binary", pa.bool_(): "boolean"}
    return ", ".join(f"{c} {names[kind]}" for c, kind in columns.items())


def _binary(parts: list[bytes], size: int) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(size), len(parts), [None, pa.py_buffer(b"".join(parts))]).cast(pa.binary())


def find_runs(docs: DataFrame, length: int) -> DataFrame:
    """(key, digest, row, lo, hi, at, times): a row for each run of ``docs(row, data)``.

    Windows lo to hi have the anchor at ``at``. A run that is followed by equal ones, as in a text of a
    short period, is one row for all of them: ``times`` copies, hi - lo + 1 bytes apart.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = _Grams(max(1, length // 4))
        for batch in batches:
            for row in range(batch.num_rows):
                data = batch.column(1)[row].as_buffer() if batch.column(1)[row].is_valid else None
                if data is None or data.size < length:
                    continue
                view = memoryview(data)
                for anchor, at, lo, hi in runs(view, length, grams):
                    names = [_digest(view[a:b]) for a, b in zip(lo.tolist(), (hi + length).tolist(), strict=True)]
                    times = np.ones(len(lo), np.int64)
                    twins = np.flatnonzero((anchor[1:] == anchor[:-1]) & (hi[1:] - lo[1:] == hi[:-1] - lo[:-1]))
                    again = np.zeros(len(lo), bool)
                    again[[i + 1 for i in twins.tolist() if names[i] == names[i + 1]]] = True
                    first = np.flatnonzero(~again)
                    if len(first) < len(lo):
                        times = np.diff(np.append(first, len(lo)))
                        names = [names[i] for i in first.tolist()]
                        anchor, at, lo, hi = anchor[first], at[first], lo[first], hi[first]
                    columns = [pa.array(anchor), _binary(names, 16), pa.array(np.full(len(lo), batch.column(0)[row].as_py(), np.int64)), *map(pa.array, (lo, hi, at, times))]
                    yield pa.RecordBatch.from_arrays(columns, ["key", "digest", "row", "lo", "hi", "at", "times"])

    return docs.select("row", "data").mapInArrow(run, "key long, digest binary, row long, lo long, hi long, at long, times long")


def _range_minimum(x: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Minimum of x[lo], ..., x[hi] for every pair, from minima of stretches of powers of two."""
    if not len(lo):
        return x[:0]
    level = np.frexp((hi - lo + 1).astype(np.float64))[1] - 1
    table = [x]
    for k in range(int(level.max())):
        below = table[-1].copy()
        np.minimum(below[: -(1 << k)], below[1 << k :], out=below[: -(1 << k)])
        table.append(below)
    rows = np.array(table) if len(table) > 1 else x[None, :]
    return np.minimum(rows[level, lo], rows[level, hi + 1 - (1 << level)])


def families(contents: list[bytes], at: np.ndarray, depth: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(d, order, lcp) for d = 0, 1, ...: the contents' numbers in the order of their suffixes that start d bytes before ``at``.

    ``lcp`` has the common prefix with the suffix before, 0 for the first. Contents that have no d bytes
    before ``at`` are left out. Bytes more than ``depth`` beyond ``at`` don't count.
    """
    sizes = np.array(list(map(len, contents)), np.int64)
    text = np.frombuffer(b"".join(contents), np.uint8)
    place = np.cumsum(sizes) - sizes + at
    tails = [c[a : a + depth] for c, a in zip(contents, at.tolist(), strict=True)]
    order = np.array(sorted(range(len(contents)), key=tails.__getitem__), np.int64)
    reach = np.minimum(depth, sizes - at)
    lcp = np.zeros(len(order), np.int32)
    for s in range(1, len(order), 4096):
        a, b = order[s - 1 : s + 4095], order[s : s + 4096]
        a = a[: len(b)]
        step = np.arange(depth)
        x, y = (text[np.minimum(place[i][:, None] + step, len(text) - 1)] for i in (a, b))
        apart = x != y
        same = np.where(apart.any(axis=1), apart.argmax(axis=1), depth)
        lcp[s : s + 4096] = np.minimum(same, np.minimum(reach[a], reach[b]))
    yield 0, order, lcp
    for d in range(1, int(at.max(initial=0)) + 1):
        on = np.flatnonzero(at[order] >= d)
        byte = text[place[order[on]] - d]
        sort = np.argsort(byte, kind="stable")
        was, byte = on[sort], byte[sort]
        fresh = np.zeros(len(was), np.int32)
        same = np.flatnonzero(byte[1:] == byte[:-1])
        fresh[same + 1] = 1 + _range_minimum(lcp, was[same] + 1, was[same + 1])
        order, lcp = order[was], fresh
        yield d, order, lcp


def previous_factor(order: np.ndarray, lcp: np.ndarray, forward: bool = True) -> np.ndarray:
    """Longest factor at each place that also starts at a smaller (else: greater) one.

    ``order`` has the places 0 to n - 1 in suffix order. The longest match among smaller places stands
    at the previous or the next smaller place in that order, the match being the least common prefix on the way
    there. Pointers to the previous smaller place are followed until all have arrived; an end without one gives 0.
    """
    value = order if forward else -order
    out = np.zeros(len(order), np.int64)
    for way in (1, -1):
        v = value[::way]
        near = lcp if way == 1 else np.append(lcp[1:], 0)[::-1]
        to = np.arange(len(v)) - 1
        least = near.astype(np.int64)
        live = np.flatnonzero((to >= 0) & (least > 0))
        while len(live := live[v[to[live]] > v[live]]):
            hop = to[live]
            least[live] = np.minimum(least[live], least[hop])
            to[live] = to[hop]
            live = live[(to[live] >= 0) & (least[live] > 0)]
        least[to < 0] = 0
        at = order[::way]
        out[at] = np.maximum(out[at], least)
    return out


def repeated_windows(contents: list[bytes], at: np.ndarray, rank: np.ndarray, length: int, keep_first: bool) -> list[np.ndarray]:
    """For each content a flag for each of its windows: an equal one starts elsewhere among the contents.

    With ``keep_first`` only windows that have an equal one in a content of smaller ``rank`` are flagged.
    """
    sizes = np.array(list(map(len, contents)), np.int64)
    ends = np.cumsum(sizes - length + 1)
    begins = ends - (sizes - length + 1)
    flag = np.zeros(int(ends[-1]) if len(ends) else 0, bool)
    for d, order, lcp in families(contents, at, length):
        # a common prefix of neighbours that long lies inside both contents
        near = lcp >= length
        if not near.any():
            continue
        both = near.copy()
        both[:-1] |= near[1:]
        order, lcp = order[both], np.where(near, lcp, 0)[both]
        window = begins[order] + at[order] - d
        if keep_first:
            place = np.argsort(np.argsort(rank[order], kind="stable"), kind="stable")
            far = previous_factor(place, lcp)[place] >= length
            window = window[far]
        flag[window] = True
    return [flag[a:b] for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]


def _stretches(flags: np.ndarray) -> list[tuple[int, int]]:
    """First and last of consecutive flagged windows."""
    edge = np.diff(np.concatenate(([0], flags.view(np.int8), [0])))
    return list(zip(np.flatnonzero(edge == 1).tolist(), (np.flatnonzero(edge == -1) - 1).tolist(), strict=True))


def _in_order(contents: DataFrame, length: int, keep_first: bool) -> DataFrame:
    """(key, digest, again, row, a, b) for contents of which each group fits one suffix order.

    Windows a to b of the document go; a row with ``again`` is for all other copies of the content,
    which go as a whole, and has the place of the first.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, last = 0, None

        def flush() -> pa.RecordBatch:
            # a content that occurs again stands for its other copies too, behind all first ones
            entries = held + [x for x in held if x[2] > 1]
            at = np.array([x[5] for x in entries], np.int64)
            places = sorted(range(len(held)), key=lambda i: (held[i][3], held[i][4] + held[i][5]))
            rank = np.arange(len(entries))
            rank[places] = np.arange(len(held))
            out = []
            for i, flags in enumerate(repeated_windows([x[6] for x in entries], at, rank, length, keep_first)):
                key, digest, _, row, lo, _, _ = entries[i]
                if i < len(held):
                    out += [(key, digest, False, row, lo + a, lo + b) for a, b in _stretches(flags)]
                elif flags.all():
                    out.append((key, digest, True, row, lo, lo))
            held.clear()
            return _batch(out, FLAG)

        for batch in batches:
            for x in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if size > CHUNK_BYTES and x[0] != last:
                    yield flush()
                    size = 0
                held.append(x)
                size, last = size + len(x[6]), x[0]
        if held:
            yield flush()

    parts = shuffle_parts(contents.sparkSession, contents.count(), PARTITION_ROWS)
    dealt = contents.select(list(CONTENT)).repartition(parts, "key").sortWithinPartitions("key", "row", "lo")
    return dealt.mapInArrow(run, _shape(FLAG))


def _cut(contents: DataFrame, length: int, windows: int) -> DataFrame:
    """Blocks of ``windows`` windows of the contents, as contents of smaller groups, with the content that they are from."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, digest, n, row, lo, at, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                out, last = [], len(data) - length
                for block in range(max(0, at - last) // windows, at // windows + 1):
                    # starts of the block's last and first window; a run may have only some of them
                    end, first = at - block * windows, at - block * windows - windows + 1
                    core = data[end : max(end, first + length)]
                    name = hashlib.blake2b(core, digest_size=8, key=f"{key} {block}".encode()).digest()
                    first, end = max(0, first), min(last, end)
                    part = data[first : end + length]
                    out.append((int.from_bytes(name, "big", signed=True), _digest(part), n, row, lo + first, at - first, part, key, digest))
                yield _batch(out, CONTENT | PARENT)

    return contents.select(list(CONTENT)).mapInArrow(run, _shape(CONTENT | PARENT))


def _kept(facts: DataFrame) -> DataFrame:
    """facts(key, n, ...) of groups in which something may repeat, with ``kinds``, the group's number of contents."""
    groups = facts.groupBy("key").agg(F.count("*").alias("kinds"), F.sum("n").alias("all")).filter(F.col("all") > 1)
    return facts.join(groups.select("key", "kinds"), "key")


def _factors(contents: DataFrame, length: int, keep_first: bool, most: int, blocks: tuple[int, ...]) -> tuple[DataFrame, DataFrame]:
    """Windows (row, a, b) that go, and contents (key, digest, row0, lo0) of which all copies but that one go as a whole."""
    hot = contents.filter(F.col("kinds") > most) if blocks else None
    cut = hot is not None and not hot.isEmpty()
    found = stage(_in_order(contents.filter(F.col("kinds") <= most) if cut else contents, length, keep_first), "factors")
    spans = found.filter(~F.col("again")).select("row", "a", "b")
    again = found.filter("again").select("key", "digest", F.col("row").alias("row0"), F.col("a").alias("lo0"))
    if cut:
        parts = stage(_cut(hot, length, blocks[0]), "blocks")
        facts = parts.groupBy("key", "digest").agg(F.sum("n").alias("n"), F.min(F.struct("row", "lo", "at", "bytes")).alias("one"))
        inner = stage(_kept(facts).select("key", "digest", "n", "kinds", "one.*"), "contents")
        more, twice = _factors(inner, length, keep_first, most, blocks[1:])
        copies = parts.join(twice, ["key", "digest"])
        other = copies.filter("row <> row0 or lo <> lo0").select("row", F.col("lo").alias("a"), (F.col("lo") + F.length("bytes") - length).alias("b"))
        spans = spans.unionByName(more).unionByName(other)
        whole = copies.filter("n > 1").select(F.col("parent").alias("key"), F.col("parent_digest").alias("digest")).distinct()
        again = again.unionByName(whole.join(hot, ["key", "digest"]).select("key", "digest", F.col("row").alias("row0"), F.col("lo").alias("lo0")))
    return spans, again


def repeated_spans(docs: DataFrame, length: int = 400, most: int = MOST_CONTENTS, keep_first: bool = False) -> DataFrame:
    """(row, lo, hi): maximal byte ranges of ``docs(row, data)`` covered by strings that also start elsewhere.

    With ``keep_first`` the first of equal strings, by (row, place), is not covered.
    """
    found = stage(find_runs(docs, length), "runs")
    facts = found.groupBy("key", "digest").agg(F.sum("times").alias("n"), F.min(F.struct("row", "lo", "hi", "at")).alias("one"))
    facts = stage(facts.select("key", "digest", "n", "one.*"), "contents")
    wanted = _kept(facts).groupBy("row").agg(F.collect_list(F.struct("key", "digest", "n", "kinds", "lo", "hi", "at")).alias("parts"))
    cut = lambda p: F.substring("data", (p.lo + 1).cast("int"), (p.hi - p.lo + length).cast("int"))
    taken = F.transform("parts", lambda p: F.struct(p.key.alias("key"), p.digest.alias("digest"), p.n.alias("n"), p.kinds.alias("kinds"), p.lo.alias("lo"), (p["at"] - p.lo).alias("at"), cut(p).alias("bytes")))
    contents = stage(docs.join(wanted, "row").select("row", F.explode(taken).alias("p")).select("row", "p.*"), "bytes")
    spans, again = _factors(contents, length, keep_first, most, BLOCKS)

    size = F.col("hi") - F.col("lo") + 1
    skipped = F.when((F.col("row") == F.col("row0")) & (F.col("lo") == F.col("lo0")), 1).otherwise(0)
    copies = found.join(again, ["key", "digest"]).withColumn("skipped", skipped).filter("skipped < times")
    copies = copies.select("row", (F.col("lo") + F.col("skipped") * size).alias("a"), (F.col("lo") + F.col("times") * size - 1).alias("b"))
    return _united(spans.unionByName(copies).select("row", F.col("a").alias("lo"), (F.col("b") + length).alias("hi")))


def _united(spans: DataFrame) -> DataFrame:
    """Maximal ranges (row, lo, hi) of a row's ranges, which are sorted, not collected."""
    before = W.partitionBy("row").orderBy("lo", "hi")
    reached = F.max("hi").over(before.rowsBetween(W.unboundedPreceding, -1))
    fresh = spans.withColumn("fresh", F.when(F.col("lo") <= reached, 0).otherwise(1))
    numbered = fresh.withColumn("number", F.sum("fresh").over(before.rowsBetween(W.unboundedPreceding, 0)))
    return numbered.groupBy("row", "number").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).select("row", "lo", "hi")


def remove_repeats(docs: DataFrame, length: int = 400, most: int = MOST_CONTENTS, keep_first: bool = False, with_kept: bool = True) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept) for every row of docs(doc_id, text).

    Removes each byte covered by a ``length``-byte string that starts at more than one place,
    in one document or several; with ``keep_first`` the first of equal strings stays. ``kept`` holds
    the remaining bytes and is left out unless ``with_kept``. Null and empty texts, and
    texts under ``length`` bytes, lose nothing. Equal texts of equal or different ids count as
    different places. Null ids are kept. An empty table gives an empty result; other columns are
    ignored. Groups of over ``most`` different contents are cut; the result does not depend on it.
    """
    prepare(docs.sparkSession)
    kept = docs.select("doc_id", F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("data"))
    kind = kept.schema["doc_id"].dataType.simpleString()
    # ids may repeat or be null: rows get the id itself where it is alone, else a number of their own
    odd = kept.groupBy("doc_id").count().filter("count > 1 or doc_id is null").limit(1)
    if kind in ("bigint", "int") and odd.isEmpty():
        rows = kept.withColumn("row", F.col("doc_id").cast("long"))
    else:
        rows = stage(kept.withColumn("row", F.monotonically_increasing_id()), "rows")
    spans = repeated_spans(rows.select("row", "data"), length, most, keep_first)
    # a range has ``length`` bytes at least, so that a row's list is far shorter than its text
    merged = spans.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("lo", "hi"))).alias("spans"))
    both = rows.join(merged, "row", "left").select("doc_id", "data", F.col("spans.lo").alias("lo"), F.col("spans.hi").alias("hi"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, gone, number, sha, left = [], [], [], [], []
            for data, lo, hi in zip(batch.column(1), batch.column(2), batch.column(3), strict=True):
                view = memoryview(data.as_buffer())
                spans = list(zip(lo.as_py(), hi.as_py(), strict=True)) if lo.is_valid else []
                parts, at = [], 0
                for a, b in spans:
                    parts.append(view[at:a])
                    at = b
                parts.append(view[at:])
                rest = b"".join(parts)
                size.append(len(view)), gone.append(len(view) - len(rest)), number.append(len(spans))
                if with_kept:
                    left.append(rest)
                sha.append(hashlib.sha256(rest).hexdigest())
            columns = {"doc_id": batch.column(0), "n_bytes": pa.array(size, pa.int64()), "n_removed": pa.array(gone, pa.int64()), "n_spans": pa.array(number, pa.int64()), "kept_sha256": pa.array(sha, pa.string())}
            yield pa.RecordBatch.from_pydict(columns | ({"kept": pa.array(left, pa.binary())} if with_kept else {}))

    return both.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string{', kept binary' * with_kept}")
