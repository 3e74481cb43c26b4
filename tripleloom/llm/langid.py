"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Document frequencies are counted over all training rows. The weights come from a bounded sample
of them (``sample_rows``), by follow-the-regularised-leader with elastic-net penalties; a fifth of
the sample is held back to fit the temperature that turns margins into probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from .common import free_name, prepare

#: Buckets that n-grams are hashed to, and the n-grams' sizes.
BUCKETS, SIZES = 1 << 14, 3
#: Characters of a very long text that are counted at once.
SEGMENT = 1 << 20
UNKNOWN = "und"
#: Different languages at most: a table of them is broadcast.
MOST_LANGUAGES = 10_000


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def counts(text: str | None) -> np.ndarray | None:
    """How often each bucket's n-grams occur in the lower-cased text; None if it has no letter."""
    if not text:
        return None
    total, any_letter, text = np.zeros(BUCKETS, np.int64), False, text.lower()
    for at in range(0, len(text), SEGMENT):
        before = min(at, SIZES - 1)
        code = np.frombuffer(text[at - before : at + SEGMENT].encode("utf-32-le", "replace"), np.uint32)
        letter = _letters()[code]
        any_letter |= bool(letter.any())
        code = np.where(letter, code, 32).astype(np.uint64)
        h = code.copy()
        for n in range(1, SIZES + 1):
            if n > 1:
                h = h[:-1] * np.uint64(0x100000001B3) + code[n - 1 :]
            mixed = (h ^ (h >> np.uint64(15))) * np.uint64(0x9E3779B97F4A7C15)
            # those that end before the segment have been counted with the one before
            mixed = mixed[max(0, before - n + 1) :]
            total += np.bincount((mixed >> np.uint64(64 - 14)).astype(np.int64), minlength=BUCKETS)
    return total if any_letter else None


def weigh(count: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The non-empty buckets of a text and their values, of length 1 together."""
    at = np.flatnonzero(count)
    value = (1 + np.log(count[at])) * idf[at]
    norm = np.sqrt((value * value).sum())
    return at, value / (norm if norm > 0 else 1)


@dataclass
class Model:
    labels: list[str]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0

    def margins(self, at: np.ndarray, value: np.ndarray) -> np.ndarray:
        return value @ self.weights[at] + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        count = counts(text)
        if count is None or not self.labels:
            return UNKNOWN, 0.0
        p = softmax(self.margins(*weigh(count, self.idf)) / self.temperature)
        best = int(p.argmax())
        return self.labels[best], float(min(1.0, p[best]))


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max())
    return e / e.sum()


def train(rows: list[tuple[str, np.ndarray, np.ndarray]], idf: np.ndarray, epochs: int = 3, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.5) -> Model:
    """FTRL-proximal over ``(label, buckets, values)`` rows, then the temperature on each fifth row."""
    labels = sorted({x[0] for x in rows})
    k, d = len(labels), len(idf)
    number = {x: i for i, x in enumerate(labels)}
    z, n = np.zeros((d + 1, k)), np.zeros((d + 1, k))
    order = np.random.default_rng(7).permutation(len(rows))
    held = [i for j, i in enumerate(order) if j % 5 == 4]
    learn = [i for j, i in enumerate(order) if j % 5 != 4] or held

    def solve(at: np.ndarray) -> np.ndarray:
        zz = z[at]
        penalty = np.where(at == d, 0.0, l1)[:, None]
        return np.where(np.abs(zz) <= penalty, 0.0, -(zz - np.sign(zz) * penalty) / ((beta + np.sqrt(n[at])) / alpha + l2))

    for _ in range(epochs):
        for i in learn:
            label, at, value = rows[i]
            at, value = np.append(at, d), np.append(value, 1.0)
            w = solve(at)
            error = softmax(value @ w)
            error[number[label]] -= 1
            g = value[:, None] * error
            grown = n[at] + g * g
            z[at] += g - (np.sqrt(grown) - np.sqrt(n[at])) / alpha * w
            n[at] = grown
    w = solve(np.arange(d + 1))
    model = Model(labels, idf, w[:d], w[d])
    if held and k > 1:
        margin = np.array([model.margins(rows[i][1], rows[i][2]) for i in held])
        truth = np.array([number[rows[i][0]] for i in held])

        def loss(t: float) -> float:
            x = margin / t
            x = x - x.max(axis=1, keepdims=True)
            return float((np.log(np.exp(x).sum(axis=1)) - x[np.arange(len(truth)), truth]).mean())

        model.temperature = min(np.exp(np.linspace(np.log(0.05), np.log(20), 121)), key=loss)
    return model


def is_held_out(column: str = "doc_id"):
    """Rows that nothing is learnt from: crc32 of the id as text, modulo 4, is 2; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _document_frequencies(rows: DataFrame) -> tuple[np.ndarray, dict[str, int]]:
    """Rows with each bucket, and rows of each language; tasks send sums, which are added up before they get here."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if (c := counts(text)) is not None:
                    df += c > 0
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(df[at])], ["bucket", "df"])

    got = rows.select("text").mapInArrow(run, "bucket long, df long").groupBy("bucket").agg(F.sum("df").alias("df")).toPandas()
    df = np.zeros(BUCKETS)
    df[got.bucket] = got.df
    found = rows.groupBy("lang").count().limit(MOST_LANGUAGES + 1).collect()
    if len(found) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    return df, {x.lang: x["count"] for x in found}


def fit(docs: DataFrame, sample_rows: int = 2000) -> Model:
    """A model of ``docs(doc_id, text, lang)``, from rows that have a language and are not held out.

    ``sample_rows`` bounds what the weights are learnt from, shared evenly by the languages (at
    least 20 rows each) and chosen by a hash of id and text; at most twice as many are ever sent.
    """
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.select("doc_id", "text", "lang").filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~is_held_out())
    df, languages = _document_frequencies(rows)
    total = sum(languages.values())
    if not total:
        return Model([], np.zeros(BUCKETS), np.zeros((BUCKETS, 0)), np.zeros(0))
    idf = np.log((1 + total) / (1 + df)) + 1
    share = max(20, sample_rows // len(languages))
    odds = spark.createDataFrame([(x, min(1.0, share / n)) for x, n in languages.items()], "lang string, odds double")
    drawn = rows.join(F.broadcast(odds), "lang").filter((F.xxhash64("doc_id", "text") % 1_000_003 + 1_000_003) % 1_000_003 < F.col("odds") * 1_000_003)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, ats, ns = [], [], []
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if (c := counts(text)) is not None:
                    at = np.flatnonzero(c)
                    labels.append(lang), ats.append(at.astype("<u4").tobytes()), ns.append(c[at].astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(labels, pa.string()), pa.array(ats, pa.binary()), pa.array(ns, pa.binary())], ["lang", "at", "n"])

    sample = drawn.select("lang", "text").limit(2 * share * len(languages)).mapInArrow(run, "lang string, at binary, n binary").collect()
    made = []
    for lang, at, n in sorted(sample, key=lambda x: (x[0], bytes(x[1]), bytes(x[2]))):
        at, n = np.frombuffer(at, "<u4").astype(np.int64), np.frombuffer(n, "<u4")
        value = (1 + np.log(n)) * idf[at]
        made.append((lang, at, value / np.sqrt((value * value).sum())))
    return train(made, idf) if made else Model([], idf, np.zeros((BUCKETS, 0)), np.zeros(0))


def predict(docs: DataFrame, model: Model, names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """docs with the language and its score under ``names``; a text that is null or has no letter is ``und`` with score 0.

    Columns of docs that have these names are replaced.
    """
    spark = docs.sparkSession
    prepare(spark)
    sent = spark.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if c not in names]
    docs = docs.select(*kept)
    schema = StructType([*docs.schema.fields, StructField(names[0], StringType()), StructField(names[1], DoubleType())])
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [sent.value.predict(t) for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([x[0] for x in got], pa.string()), pa.array([x[1] for x in got], pa.float64())], [*batch.schema.names, *names])

    return docs.mapInArrow(run, schema)


def identify(docs: DataFrame, sample_rows: int = 2000) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row of docs(doc_id, text, lang).

    Without a labelled row every text is ``und`` with score 0. Repeated ids and texts give one row
    each; an empty table gives an empty result; other columns are ignored. A prediction sees the
    text alone.
    """
    model = fit(docs, sample_rows)
    return predict(docs.select("doc_id", is_held_out().alias("held_out"), "text"), model).drop("text")


def keep_identified(docs: DataFrame, least: float = 0.3, sample_rows: int = 2000) -> DataFrame:
    """docs without rows of which the language is ``und`` or has a score below ``least``."""
    found, score = free_name(docs, "lang"), free_name(docs, "score")
    marked = predict(docs, fit(docs, sample_rows), (found, score))
    return marked.filter((F.col(found) != UNKNOWN) & (F.col(score) >= least)).select(*docs.columns)
