"""Structural checks of written files, and shape constraints on the triple table."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import vocab
from ..sources.archive import files

#: Of each source: the prefixed class names in Turtle, their IRIs, the subject's prefix and what accessions look like.
CHECKS = {
    "biosample": (["ddbjont:BioSampleRecord"], [vocab.BIOSAMPLE_ONT + "BioSampleRecord"], "idorg", r"SAM"),
    "bioproject": (["bp_ont:BioProjectRecord"], [vocab.BIOPROJECT_ONT + "BioProjectRecord"], "idorg_bp", r"PRJ"),
    "sra": ([f"dra_ont:{c}" for c in vocab.SRA_CLASSES.values()], [vocab.DRA_ONT + c for c in vocab.SRA_CLASSES.values()], "insdc_sra", r"[A-Z]"),
    "sra-experiment": (["dra_ont:Experiment"], [vocab.DRA_ONT + "Experiment"], "insdc_sra", r"[A-Z]"),
}


@dataclass
class Report:
    """``errors`` are rows (path, line, message); None if there was nothing to read."""

    files: int = 0
    records: int = 0
    error_count: int = 0
    errors: DataFrame | None = None

    @property
    def ok(self) -> bool:
        return not self.error_count


def _one_of(texts: list[str]) -> str:
    return "|".join(map(re.escape, texts))


def turtle_checks(line: Column, source: str) -> tuple[Column, Column]:
    """Whether a Turtle line begins a record, and the messages of a bad one: empty identifiers, subjects of an unlikely form."""
    classes, _, prefix, like = CHECKS[source]
    record = line.rlike(rf"^\s*a (?:{_one_of(classes)}) [;.]\s*$")
    subject = F.regexp_extract(line, rf"^{prefix}:(\S*)\s*$", 1)
    unlikely = line.startswith(f"{prefix}:") & line.rlike(rf"^{prefix}:\S*\s*$") & ~subject.rlike(f"^(?:{like})")
    empty = F.when(line.contains('dct:identifier ""'), F.lit("empty dct:identifier"))
    return record, F.array(empty, F.when(unlikely, F.concat(F.lit("unexpected accession '"), subject, F.lit("'"))))


def ntriples_checks(line: Column, source: str) -> tuple[Column, Column]:
    """Whether an N-Triples line is a record's type, and the message of one that does not end in a blank and a full stop."""
    text = F.trim(F.translate(line, "\t\r", "  "))
    said = (text != "") & ~text.startswith("#")
    record = text.rlike(rf"^<.*(?:{_one_of([f'<{vocab.RDF_TYPE}> <{iri}> .' for iri in CHECKS[source][1]])})$")
    return said & record, F.array(F.when(said & ~text.endswith(" ."), F.lit("does not end with ' .'")))


def checked_lines(lines: DataFrame, source: str) -> DataFrame:
    """lines(path, value, ...) with ``is_record`` and ``messages``, by the syntax that the path ends in."""
    kinds = [ntriples_checks(F.col("value"), source), turtle_checks(F.col("value"), source)]
    nt = F.col("path").endswith(".nt")
    return lines.withColumns({"is_record": F.when(nt, kinds[0][0]).otherwise(kinds[1][0]), "messages": F.array_compact(F.when(nt, kinds[0][1]).otherwise(kinds[1][1]))})


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, value, part, place, start): lines that Spark splits, with their order inside a split of a file."""
    read = spark.read.option("lineSep", "\n").text(paths)
    ids = F.monotonically_increasing_id()
    return read.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), "value", F.shiftright(ids, 33).alias("part"), ids.alias("place"))


def validate_files(spark: SparkSession, paths: list[str], source: str) -> tuple[DataFrame, DataFrame]:
    """(path, records, errors) of each file, and (path, line, message) of every error.

    Files are split like any text. A line's number is its place in its split and the lines of the
    splits of the file before; those numbers are only made for files that have errors.
    """
    lines = checked_lines(_lines(spark, paths), source)
    split = lines.groupBy("path", "part", "start").agg(F.min("place").alias("first"), F.count("*").alias("n"), F.count_if("is_record").alias("records"), F.sum(F.size("messages")).alias("errors"))
    before = F.coalesce(F.sum("n").over(W.partitionBy("path").orderBy("start").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    splits = split.withColumn("before", before)
    bad = splits.filter("errors > 0").select("path", "part", "start", "first", "before")
    errors = lines.filter(F.size("messages") > 0).join(bad, ["path", "part", "start"])
    errors = errors.select("path", (F.col("place") - F.col("first") + F.col("before") + 1).alias("line"), F.explode("messages").alias("message"))
    return split.groupBy("path").agg(F.sum("records").alias("records"), F.sum("errors").alias("errors")), errors


def validate(spark: SparkSession, path: str, source: str = "biosample") -> Report:
    """Check a file, or the ttl and nt files of an output folder. Errors stay rows; no more than counts come here."""
    if path.endswith((".ttl", ".nt")):
        paths = [path]
    else:
        paths = []
        for kind in ("ttl", "nt"):
            try:
                paths += [x for x in files(f"{path}/{kind}") if x.endswith(f".{kind}")]
            except FileNotFoundError:
                continue
        if not paths and "." in path.rsplit("/", 1)[-1]:
            raise ValueError(f"{path}: not a folder, .ttl or .nt file")
    if not paths:
        return Report()
    counted, errors = validate_files(spark, paths, source)
    total = counted.agg(F.sum("records").alias("records"), F.sum("errors").alias("errors")).first()
    return Report(len(paths), total.records or 0, total.errors or 0, errors)


# --- shapes --------------------------------------------------------------------------------------


def of_class(triples: DataFrame, cls: str) -> DataFrame:
    """(s): the resources of a class."""
    return triples.filter((F.col("p") == vocab.RDF_TYPE) & (F.col("o") == cls)).select("s").distinct()


def not_of_class(triples: DataFrame, classes: list[str], namespace: str) -> DataFrame:
    """(s): subjects within a namespace that are of none of the classes, so that no shape fits them; one aggregation by s."""
    isa = (F.col("p") == vocab.RDF_TYPE) & F.col("o").isin(*classes)
    return triples.filter(F.col("s").startswith(namespace)).groupBy("s").agg(F.max(isa).alias("member")).filter(~F.col("member")).select("s")


def cardinality(triples: DataFrame, cls: str, predicate: str, least: int = 1, most: int | None = 1) -> DataFrame:
    """(s, n): resources of a class with fewer or more different values than allowed; one aggregation by s."""
    found = triples.filter((F.col("p") == predicate) | ((F.col("p") == vocab.RDF_TYPE) & (F.col("o") == cls))).select("s", "p", "o", "o_datatype").distinct()
    isa = (F.col("p") == vocab.RDF_TYPE) & (F.col("o") == cls)
    counted = found.groupBy("s").agg(F.count_if(isa).alias("member"), F.count_if(F.col("p") == predicate).alias("n")).filter("member > 0")
    off = F.col("n") < least
    if most is not None:
        off = off | (F.col("n") > most)
    return counted.filter(off).select("s", "n")


def _values(triples: DataFrame, cls: str, predicate: str, wrong: Column) -> DataFrame:
    return triples.filter(F.col("p") == predicate).join(of_class(triples, cls), "s", "left_semi").filter(wrong).select("s", "o")


def datatype(triples: DataFrame, cls: str, predicate: str, wanted: str | None) -> DataFrame:
    """(s, o): values of a predicate that have another datatype."""
    return _values(triples, cls, predicate, ~F.col("o_datatype").eqNullSafe(F.lit(wanted)))


def node_kind(triples: DataFrame, cls: str, predicate: str, kind: str) -> DataFrame:
    """(s, o): values of a predicate that are not of the kind iri, bnode or literal."""
    return _values(triples, cls, predicate, F.col("o_kind") != kind)


def reference(triples: DataFrame, cls: str, predicate: str, target: str) -> DataFrame:
    """(s, o): values of a predicate that are not resources of the target class."""
    links = triples.filter(F.col("p") == predicate).join(of_class(triples, cls), "s", "left_semi").select("s", "o")
    return links.join(of_class(triples, target).withColumnRenamed("s", "o"), "o", "left_anti").select("s", "o")
