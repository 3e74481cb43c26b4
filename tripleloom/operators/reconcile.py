"""Source against output: counts, and fields read back from what was written."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import vocab
from ..functions import scalars as S


def count_tags(members: DataFrame, tag: str = "EXPERIMENT") -> int:
    """Opening tags in the texts of ``members(value)``."""
    found = F.size(F.regexp_extract_all("value", F.lit(f"(<{tag}[ >])"), F.lit(1)))
    return members.agg(F.coalesce(F.sum(found), F.lit(0)).alias("n")).first()["n"]


def counts_agree(source: int, written: int, skipped: int = 0, tolerance: float = 0.0001) -> bool:
    """Equal, apart by just the skipped rows, or apart by less than ``tolerance`` of the source."""
    apart = abs(source - written)
    return apart in (0, skipped) or (source > 0 and apart / source < tolerance)


def live_rows(lines: DataFrame, kind: str = "EXPERIMENT") -> int:
    """Live rows of one type in the TSV ``lines(value)``."""
    f = F.split("value", "\t", -1)
    return lines.filter((F.get(f, F.lit(2)) == "live") & (F.get(f, F.lit(6)) == kind)).count()


def pivot(triples: DataFrame, fields: dict[str, str]) -> DataFrame:
    """(s, a column a field): the first value, by order, of every field's predicate."""
    wanted = triples.filter(F.col("p").isin(*fields.values()))
    return wanted.groupBy("s").agg(*[F.min(F.when(F.col("p") == p, F.col("o"))).alias(n) for n, p in fields.items()])


def same(a: Column, b: Column) -> Column:
    """Equal, equal once spaces are underscores, equal as numbers, or both null."""
    folded = S.uri_local(a) == S.uri_local(b)
    number = S.parse_decimal(a) == S.parse_decimal(b)
    return a.eqNullSafe(b) | F.coalesce(folded, F.lit(False)) | F.coalesce(number, F.lit(False))


def field_fidelity(records: DataFrame, written: DataFrame, key: str, fields: list[str], sample: int | None = None) -> DataFrame:
    """(key, field, expected, found): fields that differ, and records that one side lacks.

    Both tables are joined on the key in full; ``sample`` compares the records with the smallest keys only.
    """
    left = records.select(F.col(key), *[F.col(f).cast("string").alias(f"a_{f}") for f in fields])
    if sample is not None:
        left = left.orderBy(key).limit(sample)
        written = written.join(left.select(key), key, "left_semi")
    right = written.select(F.col(key), *[F.col(f).cast("string").alias(f"b_{f}") for f in fields])
    both = left.withColumn("__l", F.lit(True)).join(right.withColumn("__r", F.lit(True)), key, "full")
    missing = F.col("__l").isNull() | F.col("__r").isNull()
    rows = [F.struct(F.lit(f).alias("field"), F.col(f"a_{f}").alias("expected"), F.col(f"b_{f}").alias("found"), (missing | ~same(F.col(f"a_{f}"), F.col(f"b_{f}"))).alias("off")) for f in fields]
    return both.select(key, F.inline(F.array(*rows))).filter("off").drop("off")


def turtle_blocks(lines: DataFrame) -> DataFrame:
    """(subject, block) from rows ``value`` that each hold one record's Turtle text, as read with a blank-line separator."""
    return lines.select(F.regexp_extract("value", r"^(\S+)\n", 1).alias("subject"), F.col("value").alias("block")).filter("subject <> '' AND subject <> '@prefix'")


def block_field(block: Column | str, predicate: str, namespace: str = vocab.DRA_ONT) -> Column:
    """A field of a Turtle block: a literal unescaped, or the local name of a term, also one written as an IRI of the namespace."""
    c = F.col(block) if isinstance(block, str) else block
    literal = F.regexp_extract(c, rf'(?m)^\s*{predicate} "((?:[^"\\]|\\.)*)"', 1)
    term = F.regexp_extract(c, rf"(?m)^\s*{predicate} \w+:(\S+)", 1)
    full = F.regexp_extract(c, rf"(?m)^\s*{predicate} <{re.escape(namespace)}(\S+)>", 1)
    return F.coalesce(F.nullif(S.unescape(literal), F.lit("")), F.nullif(term, F.lit("")), F.nullif(full, F.lit("")))


PREDICATES = {"identifier": vocab.DCT + "identifier", "title": vocab.DRA_ONT + "title"}
