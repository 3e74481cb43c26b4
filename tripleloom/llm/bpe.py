"""Exact BPE encoding by backtracking over longest matches, and decoding by an offset table.

A word is read left to right. An Aho-Corasick automaton over the vocabulary gives the longest
token at every position; a token is kept if it may follow the one before it, that is if merging
would never have crossed the border between the two (:meth:`Encoder.compatible`). Where nothing
fits, the encoder takes the next shorter token or steps back once; positions that lead nowhere
are marked, so every position is left at most once and the work is linear in the word.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator
from functools import cache, lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare

#: A vocabulary file is sent to executors whole; larger ones are refused.
MOST_VOCABULARY = 64 << 20
#: No character before this one is newer than the tables of Python and of word patterns.
_LATE = regex.compile("[\u0558-\U0010ffff]")
#: Words whose pieces a worker remembers.
REMEMBERED = 1 << 19
#: Longer words are encoded but not remembered.
LONG_WORD = 64


# fixed values: letters and digits that Unicode 16.0 added to 15.1, as the tables of word patterns have them
ADDED = """
1C89-1C8A A7CB-A7CD A7DA-A7DC 105C0-105F3 10D40-10D65 10D6F-10D85 10EC2-10EC4 11380-11389 1138B 1138E 11390-113B5 113B7
113D1 113D3 116D0-116E3 11BC0-11BE0 11BF0-11BF9 11DE0-11DE9 1246F 12475-1247F 12550-12686 13460-143FA 16100-1611D
16130-16139 16D40-16D6C 16D70-16D79 16FF4-16FF6 18CFF 1CCF0-1CCF9 1E5D0-1E5ED 1E5F0-1E5FA
""".split()
# fixed values: lower case that Unicode 16.0 and 17.0 added, as first-last:distance
LOWERED = "1C89:1 A7CC:1 A7CE:1 A7D2:1 A7D4:1 A7DA:1 A7CB:-A567 A7DC:-A641 10D50-10D65:20 16EA0-16EB8:1B".split()


def _ranges(texts: list[str]) -> list[tuple[int, int]]:
    ends = [[int(x, 16) for x in t.split("-")] for t in texts]
    return [(x[0], x[-1]) for x in ends]


@cache
def _newer() -> regex.Pattern:
    """Letters and digits of this process's patterns that Unicode 16.0 has not assigned: words have other symbols there."""
    added = {c for a, b in _ranges(ADDED) for c in range(a, b + 1)}
    unassigned = "".join(chr(c) for c in range(0x530, 0x110000) if unicodedata.category(chr(c)) == "Cn" and c not in added)
    runs = regex.findall(r"[\p{L}\p{N}]+", unassigned) or ["\uffff"]
    return regex.compile(f"[{''.join(map(regex.escape, runs))}]")


@cache
def _lowered() -> tuple[regex.Pattern, dict[int, int]]:
    pairs = {}
    for x in LOWERED:
        span, _, distance = x.partition(":")
        for a, b in _ranges([span]):
            pairs |= {c: c + int(distance, 16) for c in range(a, b + 1) if chr(c).lower() == chr(c)}
    return regex.compile("[" + ("".join(map(chr, pairs)) or "\uffff") + "]"), pairs


def byte_symbols() -> dict[int, str]:
    """The printable character that byte-level vocabularies write for each byte."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class _Memo(dict):
    """The decimal ids of words, found on first use; emptied when it is full."""

    def __init__(self, find) -> None:
        super().__init__()
        self.find = find

    def __missing__(self, word: str) -> str:
        got = self.find(word)
        if len(word) <= LONG_WORD:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = got
        return got


class Encoder:
    """Encoder and decoder of a ``tokenizers`` file of kind BPE with byte symbols.

    Supported: the normalizers NFC, Replace by one pattern and Lowercase, a Split pre-tokenizer
    of which the matches are words, an optional word-end suffix, added tokens that stand for
    themselves in the raw text, and no decoder (tokens are joined by one space).
    """

    def __init__(self, raw: bytes) -> None:
        spec = json.loads(raw)
        model = spec["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        steps = (spec["normalizer"] or {}).get("normalizers", [])
        kinds = [x["type"] for x in steps]
        if model["type"] != "BPE" or spec["decoder"] or set(kinds) - {"NFC", "Replace", "Lowercase"}:
            raise ValueError("unsupported tokenizer file")
        self.nfc, self.lower = "NFC" in kinds, "Lowercase" in kinds
        self.replaced = [(regex.compile(x["pattern"]["Regex"]), x["content"]) for x in steps if x["type"] == "Replace"]
        if [(p.pattern, to) for p, to in self.replaced] == [(r"\s+", " ")]:
            self.replaced = []  # runs of space only part words, as one space does
        split = next(x for x in spec["pre_tokenizer"]["pretokenizers"] if x["type"] == "Split")
        self.words = regex.compile(split["pattern"]["Regex"])
        self.added = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.added_pattern = regex.compile("|".join(regex.escape(x) for x in sorted(self.added, key=len, reverse=True))) if self.added else None
        self.symbol = byte_symbols()
        self._tables(model["vocab"], [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]])
        self.remembered = _Memo(self._ids)

    def _tables(self, vocab: dict[str, int], merges: list[tuple[str, str]]) -> None:
        """Ranks: base symbols first, then one per merge, in the order of the merges."""
        made = [a + b for a, b in merges]
        joined = set(made)
        base = [t for t, _ in sorted(vocab.items(), key=lambda x: x[1]) if t not in joined]
        self.rank = {t: i for i, t in enumerate(base)}
        self.parts: list[tuple[int, int]] = [(i, i) for i in range(len(base))]
        self.pair: dict[tuple[int, int], int] = {}
        for (a, b), t in zip(merges, made, strict=True):
            if t not in vocab:
                continue
            left, right = self.rank[a], self.rank[b]
            new = self.rank.setdefault(t, len(self.parts))
            if new == len(self.parts):
                self.parts.append((left, right))
            self.pair.setdefault((left, right), new)
        self.token = [""] * len(self.parts)
        for t, r in self.rank.items():
            self.token[r] = t
        self.ids = [vocab[t] for t in self.token]
        end = self.suffix
        # a token as its symbols: a word's last symbol carries the suffix and is a letter of its own
        spelled = [t[: -len(end)] if end and t.endswith(end) and t != end else t for t in self.token]
        self.spelled = [s[:-1] + chr(ord(s[-1]) + 0x10000) if len(s) != len(t) else s for s, t in zip(spelled, self.token, strict=True)]
        self.length = list(map(len, self.spelled))
        automaton = ahocorasick.Automaton()
        of = {}
        for r, s in enumerate(self.spelled):
            if self._stands(r):
                automaton.add_word(s, r)
                of[s] = r
        automaton.make_automaton()
        self.automaton, self.of = automaton, of
        self.shorter = [self._prefix(s) for s in self.spelled]
        texts = [t.encode() for t in self.token]
        by_id = sorted([*zip(self.ids, texts, strict=True), *((i, t.encode()) for t, i in self.added.items())])
        by_id = [(i, t + b" ") for i, t in by_id]
        size = by_id[-1][0] + 1
        lengths = np.zeros(size + 1, np.int64)
        for i, t in by_id:
            lengths[i + 1] = len(t)
        self.offset = np.cumsum(lengths)
        self.size = lengths[1:].astype(np.int32)
        self.blob = np.frombuffer(b"".join(t for _, t in by_id), np.uint8)

    def _prefix(self, s: str) -> int:
        """The longest other token that s begins with, -1 if there is none."""
        return next((self.of[s[:n]] for n in range(len(s) - 1, 0, -1) if s[:n] in self.of), -1)

    def _stands(self, r: int) -> bool:
        """Whether merging the token's own symbols gives the token, so that it can occur at all."""
        a, b = self.parts[r]
        return (a, b) == (r, r) or self.compatible(a, b, r)

    def compatible(self, left: int, right: int, limit: int = 1 << 60) -> bool:
        """Whether merging leaves the border between two adjacent tokens alone up to rank ``limit``.

        The two are taken apart along the border, the later merge first; the border would have
        been crossed if, at some state of both, a merge of the facing parts comes earlier than
        the merge that took either part on.
        """
        while True:
            crossing = self.pair.get((left, right))
            if crossing is not None and crossing < limit:
                return False
            if left > right:
                limit, inner = left, self.parts[left][1]
                if inner != left:
                    left = inner
                    continue
                limit, inner = right + 1, self.parts[right][0]
                if inner == right:
                    return True
                right = inner
            else:
                limit, inner = right + 1, self.parts[right][0]
                if inner != right:
                    right = inner
                    continue
                limit, inner = left, self.parts[left][1]
                if inner == left:
                    return True
                left = inner

    def pieces(self, word: str) -> list[int]:
        """Ranks of the tokens of one word, given as byte symbols with its last one marked."""
        n = len(word)
        if (whole := self.of.get(word)) is not None:
            return [whole]
        longest = [-1] * n
        length = self.length
        for last, r in self.automaton.iter(word):  # by their ends: at a start, later ones are longer
            longest[last - length[r] + 1] = r
        live = bytearray(b"\1") * (n + 1)
        out: list[int] = []
        at, r = 0, longest[0]
        while at < n:
            while r >= 0 and not (live[at + length[r]] and (not out or self.compatible(out[-1], r))):
                r = self.shorter[r]
            if r >= 0:
                out.append(r)
                at += length[r]
                r = longest[at] if at < n else -1
            elif not out:
                raise ValueError(f"no token fits {word!r}")
            else:
                live[at] = 0
                r = out.pop()
                at -= length[r]
        return out

    def _ids(self, word: str) -> str:
        """The decimal ids of a word, joined by spaces."""
        symbols = "".join(map(self.symbol.__getitem__, word.encode()))
        if self.suffix:
            symbols = symbols[:-1] + chr(ord(symbols[-1]) + 0x10000)
        ids = self.ids
        return " ".join([str(ids[r]) for r in self.pieces(symbols)])

    def _plain(self, text: str) -> list[str]:
        if self.nfc and not text.isascii():
            text = unicodedata.normalize("NFC", text)
        for pattern, to in self.replaced:
            text = pattern.sub(to, text)
        if self.lower:
            text = text.replace("Σ", "σ").lower()
        if not text.isascii() and _LATE.search(text):
            found, pairs = _lowered()
            if self.lower and found.search(text):
                text = text.translate(pairs)
            if _newer().search(text):
                # a private character is a symbol to the pattern as well
                shown = self.words.finditer(_newer().sub("\ue000", text))
                return [self.remembered[text[m.start() : m.end()]] for m in shown]
        return list(map(self.remembered.__getitem__, self.words.findall(text)))

    def encode_text(self, text: str | None) -> str:
        """The decimal ids of a text joined by one space; null is empty."""
        if not text:
            return ""
        if not self.added_pattern or not self.added_pattern.search(text):
            return " ".join(self._plain(text))
        ids, at = [], 0
        for m in self.added_pattern.finditer(text):
            ids += [*self._plain(text[at : m.start()]), str(self.added[m[0]])]
            at = m.end()
        return " ".join(ids + self._plain(text[at:]))

    def encode(self, text: str | None) -> list[int]:
        return list(map(int, self.encode_text(text).split()))

    def decode(self, ids: np.ndarray) -> bytes:
        """The tokens joined by one space, in UTF-8, gathered from one blob by their offsets."""
        if not len(ids):
            return b""
        size = self.size[ids]
        ends = np.cumsum(size)
        place = np.arange(ends[-1])
        place += np.repeat(self.offset[ids] - (ends - size), size)
        return self.blob[place][:-1].tobytes()


@lru_cache(maxsize=2)
def _encoder(raw: bytes) -> Encoder:
    return Encoder(raw)


def _vocabulary(spark, path: str):
    """The file's bytes, broadcast once; its size is checked."""
    with open(path, "rb") as f:
        raw = f.read(MOST_VOCABULARY + 1)
    if len(raw) > MOST_VOCABULARY:
        raise ValueError(f"{path} is larger than {MOST_VOCABULARY} bytes")
    return spark.sparkContext.broadcast(raw)


def encode(docs: DataFrame, path: str, with_ids: bool = True) -> DataFrame:
    """(doc_id, n_tokens, ids array<int>, ids_sha256, decoded_sha256) for every row of docs(doc_id, text).

    ``ids`` is left out unless ``with_ids``. Null and empty texts have no tokens; both digests are
    then those of nothing. Rows are independent: repeated ids and texts give one row each, an
    empty table gives an empty result, other columns are ignored. There is no shuffle.
    """
    prepare(docs.sparkSession)
    kept = docs.select("doc_id", "text")
    kind = kept.schema["doc_id"].dataType.simpleString()
    vocabulary = _vocabulary(docs.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = _encoder(vocabulary.value)
        for batch in batches:
            count, ids, one, two = [], [], [], []
            for text in batch.column(1).to_pylist():
                line = tool.encode_text(text)
                numbers = np.fromstring(line, np.int32, sep=" ")
                count.append(len(numbers))
                if with_ids:
                    ids.append(numbers)
                one.append(hashlib.sha256(line.encode()).hexdigest())
                two.append(hashlib.sha256(tool.decode(numbers)).hexdigest())
            columns = {"doc_id": batch.column(0), "n_tokens": pa.array(count, pa.int64())}
            if with_ids:
                columns["ids"] = pa.array(ids, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(columns | {"ids_sha256": pa.array(one, pa.string()), "decoded_sha256": pa.array(two, pa.string())})

    return kept.mapInArrow(run, f"doc_id {kind}, n_tokens long, {'ids array<int>, ' * with_ids}ids_sha256 string, decoded_sha256 string")


def decode(tokens: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) from (doc_id, ids): null ids give a null text, no ids an empty one."""
    kept = tokens.select("doc_id", "ids")
    kind = kept.schema["doc_id"].dataType.simpleString()
    vocabulary = _vocabulary(tokens.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = _encoder(vocabulary.value)
        for batch in batches:
            texts = [None if x is None else tool.decode(np.array(x, np.int64)).decode() for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return kept.mapInArrow(run, f"doc_id {kind}, text string")
