"""Queries on a triple table ``(source, s, p, o, o_kind, o_datatype)``; SQL of the saved templates beside them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import vocab

TERM = ["s", "p", "o", "o_kind", "o_datatype"]


def dedup(triples: DataFrame) -> DataFrame:
    """A graph is a set: equal statements count once.

    For triples as they are stored. Those of records come without repeats, and without a shuffle of
    their texts, from :meth:`~tripleloom.operators.mapping.Mapping.distinct_triples`.
    """
    return triples.select(*TERM).distinct()


def type_counts(triples: DataFrame, distinct: bool = False) -> DataFrame:
    """(class, n), most frequent first. Types are filtered before they are made different, unless they are already."""
    kinds = triples.filter(F.col("p") == vocab.RDF_TYPE)
    return (kinds if distinct else dedup(kinds)).groupBy(F.col("o").alias("class")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "class")


def triple_count(triples: DataFrame, distinct: bool = False) -> DataFrame:
    return (triples if distinct else dedup(triples)).agg(F.count("*").alias("n"))


def predicate_distribution(triples: DataFrame, distinct: bool = False) -> DataFrame:
    return (triples if distinct else dedup(triples)).groupBy("p").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "p")


def spot_lookup(triples: DataFrame, subject: str) -> DataFrame:
    return dedup(triples.filter(F.col("s") == subject)).select("p", "o").orderBy("p", "o")


def class_count(triples: DataFrame, cls: str) -> DataFrame:
    return dedup(triples.filter((F.col("p") == vocab.RDF_TYPE) & (F.col("o") == cls))).agg(F.count("*").alias("n"))


def crosslink_subjects(triples: DataFrame, namespace: str, predicate: str = vocab.RDFS + "seeAlso") -> DataFrame:
    """Different subjects that link into a namespace."""
    return triples.filter((F.col("p") == predicate) & F.col("o").startswith(namespace)).agg(F.countDistinct("s").alias("n"))


def record_links(records: DataFrame, s: Column, member: Column, links: tuple[Column, ...], namespaces: dict[str, str]) -> DataFrame:
    """What :func:`links_by_class` gives, from records that have the links as columns: a row a record, not one a link."""
    into = [F.least(*[F.when(i.startswith(ns), i) for i in links], F.lit(None).cast("string")).alias(n) for n, ns in namespaces.items()]
    return records.filter(member).select(s.alias("s"), *into).groupBy("s").agg(*[F.min(n).alias(n) for n in namespaces])


def links_by_class(triples: DataFrame, cls: str, namespaces: dict[str, str], predicate: str = vocab.RDFS + "seeAlso") -> DataFrame:
    """(s, a column a namespace): the least link of every resource of a class into each namespace; one aggregation by s."""
    isa = (F.col("p") == vocab.RDF_TYPE) & (F.col("o") == cls)
    rows = triples.filter(isa | (F.col("p") == predicate))
    into = [F.min(F.when((F.col("p") == predicate) & F.col("o").startswith(ns), F.col("o"))).alias(n) for n, ns in namespaces.items()]
    return rows.groupBy("s").agg(F.max(isa).alias("member"), *into).filter("member").drop("member")


def run_links(triples: DataFrame, cls: str = vocab.DRA_ONT + "Run") -> DataFrame:
    """Links of runs, or of another class of accessions: to samples, studies and projects."""
    return links_by_class(triples, cls, {"sra": vocab.SRA, "biosample": vocab.BIOSAMPLE, "bioproject": vocab.BIOPROJECT})


def original_attributes(triples: DataFrame) -> DataFrame:
    """(biosample, sra_run, attribute, name, value): attributes, and the runs that link to their sample."""
    p = lambda name: triples.filter(F.col("p") == vocab.SCHEMA + name)
    has = p("additionalProperty").select(F.col("s").alias("biosample"), F.col("o").alias("attribute")).distinct()
    parts = triples.filter(F.col("p").isin(vocab.SCHEMA + "name", vocab.SCHEMA + "value")).groupBy(F.col("s").alias("attribute"))
    parts = parts.agg(F.min(F.when(F.col("p") == vocab.SCHEMA + "name", F.col("o"))).alias("name"), F.min(F.when(F.col("p") == vocab.SCHEMA + "value", F.col("o"))).alias("value"))
    runs = triples.filter((F.col("p") == vocab.RDF_TYPE) & (F.col("o") == vocab.DRA_ONT + "Run")).select(F.col("s").alias("sra_run")).distinct()
    links = triples.filter((F.col("p") == vocab.RDFS + "seeAlso") & F.col("o").startswith(vocab.BIOSAMPLE)).select(F.col("s").alias("sra_run"), F.col("o").alias("biosample")).distinct()
    return has.join(parts, "attribute").join(links.join(runs, "sra_run", "left_semi"), "biosample", "left").select("biosample", "sra_run", "attribute", "name", "value")


def project_metadata(records: DataFrame) -> DataFrame:
    return records.select("accession", "title", F.coalesce("name", "title").alias("label"), "release_date", "submission_date")


def experiment_metadata(records: DataFrame) -> DataFrame:
    return records.select("accession", "title", "design_description", "platform", "instrument_model", "library_name", "library_strategy", "library_source", "library_selection", F.col("library_layout.kind").alias("library_layout"))


def by_platform(records: DataFrame, platform: str) -> DataFrame:
    return experiment_metadata(records).filter(F.col("platform") == platform)


def by_strategy(records: DataFrame, strategy: str) -> DataFrame:
    return experiment_metadata(records).filter(F.col("library_strategy") == strategy)
