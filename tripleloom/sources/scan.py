"""Record scans: text that Spark splits, native parsing, and bad rows as data.

A scan yields ``record`` (null for a bad row) and ``error`` (null for a good one) beside the file,
so records and errors are two filters of one plan.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import vocab
from ..functions import scalars as S
from .archive import files, open_path, register

SRA_COLUMNS = {"accession": 0, "submission": 1, "updated": 3, "published": 4, "sra_type": 6, "center": 7, "experiment": 10, "sample": 11, "study": 12, "biosample": 17, "bioproject": 18}
ARITY, HEADER = 20, "Accession\t"
_TEXT = "string"
BIOSAMPLE_XML = """_accession string, _submission_date string, _last_update string, _publication_date string, Description struct<Title: string>,
Attributes struct<Attribute: array<struct<_attribute_name: string, _harmonized_name: string, _display_name: string, _VALUE: string>>>, _corrupt_record string"""
BIOPROJECT_XML = """Project struct<Project: struct<ProjectID: struct<ArchiveID: array<struct<_accession: string>>>,
ProjectDescr: struct<Name: array<string>, Title: array<string>, Description: array<string>, ProjectReleaseDate: array<string>>,
ProjectType: struct<ProjectTypeSubmission: struct<Target: struct<Organism: array<struct<_taxID: string, OrganismName: string>>>>>>,
Submission: struct<_submitted: string>>, _corrupt_record string"""
EXPERIMENT_XML = """_accession string, TITLE string, DESIGN struct<DESIGN_DESCRIPTION: string, LIBRARY_DESCRIPTOR: struct<LIBRARY_NAME: string,
LIBRARY_STRATEGY: string, LIBRARY_SOURCE: string, LIBRARY_SELECTION: string, LIBRARY_CONSTRUCTION_PROTOCOL: string>>, _corrupt_record string"""


@dataclass
class Parsed:
    rows: DataFrame

    @property
    def records(self) -> DataFrame:
        return self.rows.filter("error IS NULL").select("record.*")

    @property
    def errors(self) -> DataFrame:
        return self.rows.filter("error IS NOT NULL").select("file", "accession", "error", "message")


def _result(rows: DataFrame, record: Column, accession: Column, error: Column, message: Column) -> Parsed:
    """Rows as (file, accession, record, error, message)."""
    return Parsed(rows.select("file", accession.alias("accession"), F.when(error.isNull(), record).alias("record"), error.alias("error"), F.when(error.isNotNull(), message).alias("message")))


def sra_rows(lines: DataFrame, header: Column | None = None) -> Parsed:
    """Accession rows from ``lines(file, value)``: blank and header lines go, then rows by arity, status and type.

    ``header`` tells header lines; without it they are those that begin with the first column's name.
    Short rows and live rows of an unknown type are errors; rows that are not live go without a trace.
    """
    text = F.regexp_replace("value", "[\r\n]+$", "")
    head = F.col("value").startswith(HEADER) if header is None else header
    rows = lines.withColumns({"value": text, "head": head}).filter((F.length("value") > 0) & ~F.col("head"))
    rows = rows.select("file", F.split("value", "\t", -1).alias("f"))
    short = F.size("f") < ARITY
    at = lambda i: F.get("f", F.lit(i))
    rows = rows.filter(short | (at(2) == "live"))
    known = at(6).isin(*vocab.SRA_CLASSES)
    record = F.struct(*[(at(i) if n in ("accession", "sra_type") else S.nonempty(at(i))).alias(n) for n, i in SRA_COLUMNS.items()])
    error = F.when(short, "TsvParse").when(~known, "TsvParse")
    message = F.when(short, F.concat(F.lit(f"expected {ARITY} columns, got "), F.size("f").cast("string"))).otherwise(F.concat(F.lit("unknown type: "), at(6)))
    return _result(rows, record, at(0), error, message)


def _lines(spark: SparkSession, path: str, end: str | None = None) -> DataFrame:
    reader = spark.read.option("lineSep", end) if end else spark.read
    return reader.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")


def _pieces(rows: DataFrame, tag: str) -> DataFrame:
    """(file, xml): each piece from its last opening tag on, closed again; pieces without one go.

    Records that close themselves stand in front of that tag, so they are dropped.
    """
    cut = F.regexp_extract("value", rf"(?s)^.*(<{tag}(?=[\s>]).*)$", 1)
    return rows.select("file", cut.alias("piece")).filter("piece <> ''").select("file", F.concat("piece", F.lit(f"</{tag}>")).alias("xml"))


def _xml(rows: DataFrame, schema: str) -> DataFrame:
    return rows.withColumn("x", F.from_xml("xml", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}))


def _filled(c: Column) -> Column:
    return F.when(c != "", c)


def _last(array: str) -> Column:
    return F.element_at(F.col(array), -1)


def _checked(accession: Column) -> tuple[Column, Column]:
    broken = F.col("x").isNull() | F.col("x._corrupt_record").isNotNull()
    error = F.when(broken, "XmlParse").when(F.coalesce(accession, F.lit("")) == "", "MissingAccession")
    return error, F.when(broken, F.concat(F.lit("not well-formed: "), F.substring("xml", 1, 200))).otherwise("record without accession")


def _times(tag: str, column: str = "xml") -> Column:
    """How often a text occurs in a column."""
    return (F.length(column) - F.length(F.replace(column, F.lit(tag), F.lit("")))) / len(tag)


def biosample_rows(pieces: DataFrame) -> Parsed:
    """Titles and attributes may stand under any child of the record. Nearly all are under Description and
    Attributes, which the schema has; only rows that have others are looked through again.
    """
    rows = _xml(_pieces(pieces, "BioSample"), BIOSAMPLE_XML)
    title = F.col("x.Description.Title")
    titles = F.filter(F.xpath("xml", F.lit("/BioSample/*/Title/text()")), lambda t: F.trim(t) != "")
    more_titles = _times("<Title") > F.when(title.isNotNull(), 1).otherwise(0)
    title = F.when(more_titles, F.trim(F.get(titles, F.size(titles) - 1))).otherwise(_filled(title))
    known = F.col("x.Attributes.Attribute")
    each = F.regexp_extract_all("xml", F.lit(r"""(?s)(<Attribute\s(?:[^>"']|"[^"]*"|'[^']*')*(?:/>|(?<!/)>.*?</Attribute>))"""), F.lit(1))
    again = F.from_xml(F.concat(F.lit("<BioSample><Attributes>"), F.array_join(each, ""), F.lit("</Attributes></BioSample>")), BIOSAMPLE_XML)
    more = _times("<Attribute ") > F.coalesce(F.size(known), F.lit(0))
    rows = rows.withColumn("all_attributes", F.when(F.col("x").isNotNull() & F.col("x._corrupt_record").isNull() & more, again["Attributes"]["Attribute"]).otherwise(known))
    attribute = lambda a: F.struct(a["_attribute_name"].alias("attribute_name"), a["_harmonized_name"].alias("harmonized_name"), a["_display_name"].alias("display_name"), _filled(a["_VALUE"]).alias("value"))
    named = F.filter("all_attributes", lambda a: F.coalesce(a["_harmonized_name"], a["_attribute_name"]).isNotNull())
    attributes = F.coalesce(F.transform(named, attribute), F.array().cast("array<struct<attribute_name:string,harmonized_name:string,display_name:string,value:string>>"))
    record = F.struct(
        F.col("x._accession").alias("accession"),
        F.col("x._submission_date").alias("submission_date"),
        F.col("x._last_update").alias("last_update"),
        F.col("x._publication_date").alias("publication_date"),
        title.alias("title"),
        attributes.alias("attributes"),
    )
    return _result(rows, record, F.col("x._accession"), *_checked(F.col("x._accession")))


def bioproject_rows(pieces: DataFrame) -> Parsed:
    rows = _xml(_pieces(pieces, "Package"), BIOPROJECT_XML)
    first = lambda array: F.get(F.filter(array, lambda v: v.isNotNull() & (v != "")), F.lit(0))
    of, project = "x.Project.Project.ProjectDescr", "x.Project.Project"
    accession = _last(f"{project}.ProjectID.ArchiveID")["_accession"]
    organism = _last(f"{project}.ProjectType.ProjectTypeSubmission.Target.Organism")
    record = F.struct(
        accession.alias("accession"),
        first(f"{of}.Name").alias("name"),
        first(f"{of}.Title").alias("title"),
        first(f"{of}.Description").alias("description"),
        organism["OrganismName"].alias("organism_name"),
        organism["_taxID"].alias("taxonomy_id"),
        _filled(_last(f"{of}.ProjectReleaseDate")).alias("release_date"),
        F.col("x.Project.Submission._submitted").alias("submission_date"),
    )
    return _result(rows, record, accession, *_checked(accession))


def experiment_rows(members: DataFrame) -> Parsed:
    """Experiments from ``members(file, value)``: one XML text each, which may hold several."""
    each = members.select("file", F.explode(F.split("value", "</EXPERIMENT>")).alias("value"))
    rows = _xml(_pieces(each, "EXPERIMENT"), EXPERIMENT_XML)
    library = "x.DESIGN.LIBRARY_DESCRIPTOR"
    # what these patterns look at has no comments
    rows = rows.withColumn("clean", F.when(F.contains("xml", F.lit("<!--")), F.regexp_replace("xml", "(?s)<!--.*?-->", "")).otherwise(F.col("xml")))
    vendor = F.regexp_extract("clean", r"(?s)<PLATFORM>\s*<(?!INSTRUMENT_MODEL)([A-Za-z_][\w.-]*)", 1)
    model = F.regexp_extract("clean", r"(?s)<PLATFORM>.*?<INSTRUMENT_MODEL>\s*([^<]*?)\s*</INSTRUMENT_MODEL>", 1)
    layout = r"(?s)<LIBRARY_LAYOUT>\s*<(SINGLE|PAIRED)\b([^>]*)>"
    sized = lambda n: S.parse_decimal(F.regexp_extract(F.regexp_extract("clean", layout, 2), rf"{n}\s*=\s*[\"']([^\"']*)[\"']", 1))
    kind = _filled(F.regexp_extract("clean", layout, 1))
    paired = F.when(kind == "PAIRED", F.lit(True))
    record = F.struct(
        F.col("x._accession").alias("accession"),
        _filled(F.col("x.TITLE")).alias("title"),
        _filled(F.col("x.DESIGN.DESIGN_DESCRIPTION")).alias("design_description"),
        *[_filled(F.col(f"{library}.{n.upper()}")).alias(n) for n in ("library_name", "library_strategy", "library_source", "library_selection", "library_construction_protocol")],
        _filled(vendor).alias("platform"),
        _filled(_unescaped(model)).alias("instrument_model"),
        F.struct(kind.alias("kind"), F.when(paired, sized("NOMINAL_LENGTH")).alias("nominal_length"), F.when(paired, sized("NOMINAL_SDEV")).alias("nominal_sdev")).alias("library_layout"),
    )
    return _result(rows, record, F.col("x._accession"), *_checked(F.col("x._accession")))


def _unescaped(c: Column) -> Column:
    """Character references in a text, by the XML parser."""
    parsed = F.from_xml(F.concat(F.lit("<r><t>"), c, F.lit("</t></r>")), "t string")["t"]
    return F.when(F.contains(c, F.lit("&")), parsed).otherwise(c)


def _headers(path: str) -> list[str]:
    """The different first lines of files that begin with a header, blank lines before it aside."""
    found = set()
    for file in files(path):
        system, at = open_path(file)
        with system.open_input_stream(at) as f:
            first = next((line for line in f.read(1 << 16).decode("utf-8", "replace").split("\n") if line.strip("\r")), "")
        if first.startswith(HEADER):
            found.add(first.rstrip("\r"))
    return sorted(found)


def read_sra(spark: SparkSession, path: str) -> Parsed:
    """A file's first line that is not blank may be a header; a later line like it, further on than the first split, is a row."""
    header = (F.col("start") == 0) & F.regexp_replace("value", "\r+$", "").isin(_headers(path))
    return sra_rows(_lines(spark, path), header)


def read_biosample(spark: SparkSession, path: str) -> Parsed:
    """Plain files are split at the closing tag; gzip, known by its suffix, is one task a file."""
    return biosample_rows(_lines(spark, path, "</BioSample>"))


def read_bioproject(spark: SparkSession, path: str) -> Parsed:
    return bioproject_rows(_lines(spark, path, "</Package>"))


def read_experiments(spark: SparkSession, path: str) -> Parsed:
    """Members ``*.experiment.xml`` of tar archives, plain or gzip by their first bytes.

    An archive is read by one task in its order; its members are then dealt out for parsing.
    """
    register(spark)
    members = spark.read.format("tar_members").option("suffix", ".experiment.xml").load(path)
    return experiment_rows(members.repartition(max(1, spark.sparkContext.defaultParallelism)))


SOURCES = {"sra": read_sra, "biosample": read_biosample, "bioproject": read_bioproject, "sra-experiment": read_experiments}


def read_source(spark: SparkSession, source: str, path: str) -> Parsed:
    return SOURCES[source](spark, path)
