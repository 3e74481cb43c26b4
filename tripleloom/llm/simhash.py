"""SimHash near-duplicates by a binary trie self-join.

Fingerprints are 64-bit majorities over the XXH64 values of word shingles. Two fingerprints
that differ in at most three bits agree on one of four 16-bit blocks, so each distinct
fingerprint goes to four tasks, one per block rotated to the top. A task is a set of tries
(one per block value); within it pairs of nodes are walked down together, and a pair is left
as soon as the bits that differ on its paths exceed the budget. The first steps of that walk are made
in Spark for blocks with too many fingerprints: a pair of nodes becomes the pairs of their children
that are within the budget, level by level, until each pair of subtrees fits a task.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, free_name, prepare, shuffle_parts, stage

BITS, BLOCKS = 64, 4
BLOCK_BITS = BITS // BLOCKS
#: Fingerprints of a pair of subtrees at most, and bits by which larger ones are cut.
SUBTREE_ROWS, STEP = 1 << 18, 4
#: Rows of a task that is one subtree, and of the two of a pair.
SELF, FIRST, SECOND = 0, 1, 2
#: Node pairs below this product are compared directly.
DIRECT = 64
#: Node pairs held at once while a trie is walked.
FRONT = 1 << 18


def fingerprint(text: bytes | None, width: int = 3, seed: int = 42) -> int:
    """The 64-bit SimHash of a text: 0 without words, the whole sequence if under ``width`` words."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    line, n = b" ".join(words), max(1, len(words) - width + 1)
    gaps = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
    starts = np.concatenate(([0], gaps + 1))[:n].tolist()
    ends = np.append(gaps, len(line))[-n:].tolist()
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, 1 << 16):
        cuts = map(slice, starts[at : at + (1 << 16)], ends[at : at + (1 << 16)])
        h = np.frombuffer(b"".join(map(xxhash.xxh64_digest, map(line.__getitem__, cuts), repeat(seed))), ">u8").astype(np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """(doc_id, fp) for every row; fp is the fingerprint as a signed long. A null text has no words."""
    prepare(docs.sparkSession)
    kept = docs.select(F.col("doc_id"), F.col("text").cast("binary").alias("text"))
    kind = kept.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t, width) for t in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    return kept.mapInArrow(run, f"doc_id {kind}, fp long")


def _merge(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Union of the sets of i and j; label holds the least index of each set."""
    while True:
        a, b = label[i], label[j]
        on = a != b
        if not on.any():
            return label
        i, j, a, b = i[on], j[on], a[on], b[on]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(up := label[label], label):
            label = up


def trie_links(task: np.ndarray, keys: np.ndarray, budget: int, side: np.ndarray | None = None, top: int = BLOCK_BITS) -> np.ndarray:
    """Sets of keys linked within ``budget`` differing bits, for each task apart.

    ``task`` numbers rows below 2**top, ``keys`` are 64-bit values that agree on their ``top`` bits
    within a task. Where ``side`` is given and is not SELF, a task is a pair of subtrees, FIRST below
    SECOND in order, and only links between them are looked for. The result labels each row with one
    row of its set. The budget is raised bit by bit; a pair of nodes whose rows are all in one set
    already is left at once.
    """
    low = np.uint64((1 << (BITS - top)) - 1)
    word = (task.astype(np.uint64) << np.uint64(BITS - top)) | (keys & low)
    order = np.argsort(word, kind="stable")
    k, n = word[order], len(word)
    label = np.arange(n)
    if n:
        same = np.flatnonzero(k[1:] == k[:-1])
        label = _merge(label, same, same + 1)
    root = np.flatnonzero(np.concatenate(([True], (k[1:] ^ k[:-1]) > low))) if n else np.zeros(0, np.int64)
    root_end = np.append(root[1:], n)
    other, other_end = root, root_end
    if side is not None and n:
        part = side[order]
        begin = root + np.add.reduceat((part == FIRST).astype(np.int64), root)
        both = (part[root] == SELF) | (begin > root) & (begin < root_end)
        other = np.where(part[root] == SELF, root, begin)[both]
        root_end = np.where(part[root] == SELF, root_end, begin)[both]
        other_end, root = other_end[both], root[both]
    for most in range(1, budget + 1):
        label = _walk(k, label, (root, root_end, other, other_end), most, top)
    out = np.empty(n, np.int64)
    out[order] = order[label]
    return out


def _walk(k: np.ndarray, label: np.ndarray, roots: tuple[np.ndarray, ...], most: int, top: int) -> np.ndarray:
    """Labels after the pairs of nodes (alo to ahi, blo to bhi) are walked down from ``roots``."""
    turn = np.concatenate(([0], np.cumsum(label[1:] != label[:-1])))
    stack = [(*(x[s : s + FRONT] for x in roots), np.full(len(roots[0][s : s + FRONT]), top, np.int64)) for s in range(0, len(roots[0]), FRONT)]
    found_i, found_j, held = [], [], 0
    while stack:
        alo, ahi, blo, bhi, depth = stack.pop()
        done = (turn[alo] == turn[ahi - 1]) & (turn[blo] == turn[bhi - 1]) & (label[alo] == label[blo])
        shift = (BITS - depth).astype(np.uint64)
        far = np.where(depth > 0, np.bitwise_count((k[alo] ^ k[blo]) >> np.minimum(shift, np.uint64(63))), 0)
        on = ~done & (far <= most)
        alo, ahi, blo, bhi, depth = alo[on], ahi[on], blo[on], bhi[on], depth[on]
        if not len(alo):
            continue
        small = (ahi - alo) * (bhi - blo) <= DIRECT
        small |= depth >= BITS
        if small.any():
            sa, na, sb, nb = alo[small], (ahi - alo)[small], blo[small], (bhi - blo)[small]
            for s in range(0, len(sa), FRONT // 8):
                cut = slice(s, s + FRONT // 8)
                size = na[cut] * nb[cut]
                at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                width = np.repeat(nb[cut], size)
                i, j = np.repeat(sa[cut], size) + at // width, np.repeat(sb[cut], size) + at % width
                hit = (i < j) & (np.bitwise_count(k[i] ^ k[j]) <= most)
                i, j = i[hit], j[hit]
                fresh = label[i] != label[j]
                found_i.append(i[fresh])
                found_j.append(j[fresh])
                held += int(fresh.sum())
            if held > FRONT:
                label = _merge(label, np.concatenate(found_i), np.concatenate(found_j))
                turn = np.concatenate(([0], np.cumsum(label[1:] != label[:-1])))
                found_i, found_j, held = [], [], 0
        alo, ahi, blo, bhi, depth = alo[~small], ahi[~small], blo[~small], bhi[~small], depth[~small]
        if not len(alo):
            continue
        bit = np.uint64(1) << (BITS - 1 - depth).astype(np.uint64)
        keep = ~((bit << np.uint64(1)) - np.uint64(1))
        amid = np.clip(np.searchsorted(k, (k[alo] & keep) | bit), alo, ahi)
        bmid = np.clip(np.searchsorted(k, (k[blo] & keep) | bit), blo, bhi)
        twin = alo == blo
        nxt = []
        for x0, x1, y0, y1, mirror in ((alo, amid, blo, bmid, False), (alo, amid, bmid, bhi, False), (amid, ahi, blo, bmid, True), (amid, ahi, bmid, bhi, False)):
            on = (x0 < x1) & (y0 < y1)
            if mirror:
                on &= ~twin
            nxt.append((x0[on], x1[on], y0[on], y1[on], depth[on] + 1))
        joined = [np.concatenate(c) for c in zip(*nxt, strict=True)]
        stack += [tuple(c[s : s + FRONT] for c in joined) for s in range(0, len(joined[0]), FRONT)]
    if held:
        label = _merge(label, np.concatenate(found_i), np.concatenate(found_j))
    return label


def _halved(pairs: DataFrame, depth: int, budget: int) -> DataFrame:
    """The rows of pairs of nodes at ``depth`` dealt to the pairs of their descendants at depth + STEP that are within the budget."""
    nodes = 1 << STEP
    own = F.shiftrightunsigned("rot", BITS - depth - STEP).bitwiseAND(F.lit(nodes - 1))
    rows = pairs.withColumn("u", own).withColumn("v", F.explode(F.array(*[F.lit(i).cast("long") for i in range(nodes)])))
    rows = rows.filter(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) + F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= budget)
    below = lambda x, y: F.shiftleft(x, STEP).bitwiseOR(F.col(y))
    alone = F.col("side") == SELF
    first = F.when(alone, F.col("u") <= F.col("v")).otherwise(F.col("side") == FIRST)
    side = F.when(alone & (F.col("u") == F.col("v")), SELF).when(first, FIRST).otherwise(SECOND)
    return rows.select("fp", "r", "rot", F.when(first, below("a", "u")).otherwise(below("a", "v")).alias("a"), F.when(first, below("b", "v")).otherwise(below("b", "u")).alias("b"), side.alias("side"))


def _dealt(rows: DataFrame, most: int, budget: int) -> DataFrame:
    """(fp, rot, task, side): every row of ``rows(fp, r, rot)`` for each pair of subtrees that it is compared in.

    A pair of nodes with over ``most`` rows goes down STEP bits at once. Two fingerprints have two rows
    at most in any pair of the last level, so that this ends.
    """
    prefix, depth, out = F.shiftrightunsigned("rot", BITS - BLOCK_BITS), BLOCK_BITS, None
    live = rows.withColumns({"a": prefix, "b": prefix, "side": F.lit(SELF)})
    while True:
        heavy = None
        if depth < BITS:
            heavy = stage(live.groupBy("r", "a", "b").count().filter(F.col("count") > most).select("r", "a", "b"), "heavy")
            if heavy.isEmpty():
                heavy = None
        ready = live if heavy is None else live.join(heavy, ["r", "a", "b"], "left_anti")
        ready = ready.select("fp", "rot", F.xxhash64(F.lit(depth), "r", "a", "b").alias("task"), "side")
        out = ready if out is None else out.unionByName(ready)
        if heavy is None:
            return out
        live = stage(_halved(live.join(heavy, ["r", "a", "b"], "left_semi"), depth, budget), "subtrees")
        depth += STEP


def links(fps: DataFrame, budget: int = 3, subtree_rows: int = SUBTREE_ROWS) -> DataFrame:
    """Edges (a, b) between distinct fingerprints ``fps(fp)``; they join what ``budget`` bits link.

    Each task returns a spanning star of every set that it found, not all of its pairs.
    """
    if budget >= BLOCKS:
        raise ValueError(f"{BLOCKS} blocks find at most {BLOCKS - 1} differing bits")
    spark = fps.sparkSession
    rot = F.when(F.col("r") == 0, F.col("fp"))
    for r in range(1, BLOCKS):
        rot = rot.when(F.col("r") == r, F.shiftleft("fp", r * BLOCK_BITS).bitwiseOR(F.shiftrightunsigned("fp", BITS - r * BLOCK_BITS)))
    rows = fps.select("fp", F.explode(F.array(*map(F.lit, range(BLOCKS)))).alias("r")).withColumn("rot", rot)
    parts = shuffle_parts(spark, BLOCKS * fps.count(), subtree_rows)
    dealt = _dealt(rows, max(2, subtree_rows), budget).repartition(parts, "task")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [(b.column(0).to_numpy(), b.column(1).to_numpy(), b.column(2).to_numpy(), b.column(3).to_numpy()) for b in batches if b.num_rows]
        if not got:
            return
        fp, key, task, side = (np.concatenate(x) for x in zip(*got, strict=True))
        _, number = np.unique(task, return_inverse=True)
        room = 1 << BLOCK_BITS
        for at in range(0, int(number.max()) + 1, room):
            on = (number >= at) & (number < at + room)
            own = fp[on]
            label = trie_links(number[on] - at, key[on].view(np.uint64), budget, side[on])
            tied = np.flatnonzero(own != own[label])
            yield pa.RecordBatch.from_arrays([pa.array(own[tied]), pa.array(own[label[tied]])], ["a", "b"])

    return dealt.mapInArrow(run, "a long, b long")


def _components(fps: DataFrame, budget: int, subtree_rows: int) -> DataFrame:
    """(fp, least, root) of every different fingerprint of ``fps(doc_id, fp)``; least is its smallest doc_id."""
    classes = stage(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    roots = components(links(classes.select("fp"), budget, subtree_rows)).select(F.col("v").alias("fp"), "root")
    return classes.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, budget: int = 3, width: int = 3, subtree_rows: int = SUBTREE_ROWS) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs(doc_id, text)``.

    Null and empty texts have the fingerprint zero, which is linked like any other. Equal ids or
    texts give one result row per input row; a null doc_id is never a component_id unless all ids
    of the component are null. An empty table gives an empty result; other columns are ignored.
    """
    fps = stage(fingerprints(docs, width), "fps")
    rooted = _components(fps, budget, subtree_rows)
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    known = rooted.join(least, "root").select("fp", "component_id")
    return fps.join(known, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, budget: int = 3, width: int = 3) -> DataFrame:
    """One row of docs for every component: the smallest by doc_id (null last), fingerprint, text and the other columns.

    Rows are told apart by a digest of all columns, so those that share an id, or have none, stay if they
    are in different components; of rows equal in all one stays. Fingerprints and digests alone go
    through the search; the texts are shuffled once, to meet the digests that were chosen.
    """
    names, key = docs.columns, free_name(docs, "key")
    row = F.sha2(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.sha2(F.coalesce(F.col("text"), F.lit("")), 256), F.hex(F.xxhash64(*names))), 256)
    keyed = docs.select(*names, row.alias(key))
    fps = stage(fingerprints(keyed.select(F.struct("doc_id", F.col(key).alias("key")).alias("doc_id"), "text"), width).select("doc_id.doc_id", "doc_id.key", "fp"), "fps")
    rooted = _components(fps.select("doc_id", "fp"), budget, SUBTREE_ROWS).select("fp", "root")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "fp", "key")
    by_print = fps.groupBy("fp").agg(F.min(order).alias("first"))
    firsts = by_print.join(rooted, "fp").groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.key").alias(key))
    # equal rows have one digest, and are next to each other after the join by it
    return keyed.join(firsts, key, "left_semi").dropDuplicates([key]).select(*names)
