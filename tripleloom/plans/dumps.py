"""Dumps of the four sources, made from the star schema: files that the scans, the sink and the validator work on."""

from __future__ import annotations

import io
import tarfile
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import vocab
from ..sources.archive import open_path

#: Accession types in the order that keys are given them; the last one is not known.
KINDS = [*vocab.SRA_CLASSES, "BOOK"]
#: Experiments of a member of an archive.
MEMBER_ROWS = 40
c = F.col


def workspace(spark: SparkSession) -> str:
    """A new folder that driver and executors share: under spark.checkpoint.dir, else, in local mode, a temporary one."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="dumps_")
    return f"{path.rstrip('/')}/dump_{uuid.uuid4().hex}"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(name: str) -> Column:
    return c(name).cast("string")


def _xml(value: Column | str) -> Column:
    out = c(value) if isinstance(value, str) else value
    for a, b in (("&", "&amp;"), ("<", "&lt;")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def _join(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def sra(spark: SparkSession, sf_dir: str) -> str:
    """Accession rows from orders: files with a header and a blank line, suppressed and short rows, an unknown type."""
    key, cust = _text("o_orderkey"), _text("o_custkey")
    day = _join(F.date_format("o_orderdate", "yyyy-MM-dd"), "T00:00:00Z")
    f: list[Column] = [F.lit("-")] * 20
    f[0], f[1], f[2] = _join("DRR", key), F.lit("S1"), F.when(c("o_orderstatus") == "P", "suppressed").otherwise("live")
    f[3], f[4] = day, F.when(c("o_orderkey") % 5 == 0, "-").otherwise(day)
    f[6] = F.get(F.array(*map(F.lit, KINDS)), (c("o_orderkey") % len(KINDS)).cast("int"))
    f[10], f[12], f[17] = _join("DRX", cust), F.lit(""), _join("SAMD", cust)
    f[18] = F.when(c("o_orderkey") % 2 == 0, _join("PRJDB", _text("o_custkey"))).otherwise("-")
    line = F.when(c("o_orderkey") % 89 == 0, F.concat_ws("\t", *f[:3])).otherwise(F.concat_ws("\t", *f))
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    header = "\n" + "\t".join(["Accession", *[f"column{i}" for i in range(1, 20)]]) + "\n"
    path = workspace(spark)
    _table(spark, sf_dir, "orders").repartition(3, "o_orderkey").select(F.when(first, _join(header, line)).otherwise(line)).write.text(path)
    return path


def biosample(spark: SparkSession, sf_dir: str, codec: str = "none") -> str:
    """Samples from customers: some without accession, some with title and attributes under other parents."""
    names = [("market segment", ' harmonized_name="segment"', _join(">", _xml("c_mktsegment"), "</Attribute>")), ("odd &quot;name&quot; %", "", F.lit(">x</Attribute>")), ("none", "", F.lit("/>"))]
    attributes = F.concat(*[_join(f'<Attribute attribute_name="{n}"{h}', end) for n, h, end in names])
    odd = c("c_custkey") % 7 == 0
    parents = lambda a, b: F.when(odd, a).otherwise(b)
    accession = F.when(c("c_custkey") % 50 == 0, "").otherwise(_join(' accession="SAMD', _text("c_custkey"), '"'))
    title = _join("<Title>", _xml("c_name"), " &amp; co</Title>")
    body = F.concat(parents(F.lit("<Names>"), F.lit("<Description>")), title, parents(F.lit("</Names>"), F.lit("</Description>")), parents(F.lit("<More>"), F.lit("<Attributes>")), attributes, parents(F.lit("</More>"), F.lit("</Attributes>")))
    line = _join("<BioSample", accession, ' submission_date="2001-01-01" last_update="2002-01-01">', body, "</BioSample>")
    path = workspace(spark)
    _table(spark, sf_dir, "customer").repartition(2, "c_custkey").select(line).write.option("compression", codec).text(path)
    return path


def bioproject(spark: SparkSession, sf_dir: str) -> str:
    """Projects from parts, some without a name, some without accession."""
    key = _text("p_partkey")
    archive = F.when(c("p_partkey") % 41 == 0, "").otherwise(_join('<ProjectID><ArchiveID accession="PRJDB', key, '"/></ProjectID>'))
    name = F.when(c("p_partkey") % 3 == 0, "").otherwise(_join("<Name>", _xml("p_brand"), "</Name>"))
    descr = _join("<ProjectDescr>", name, "<Title>", _xml("p_name"), "</Title><Description>", _xml("p_type"), "</Description></ProjectDescr>")
    line = _join("<Package><Project><Project>", archive, descr, '</Project><Submission submitted="2002-01-01"/></Project></Package>')
    path = workspace(spark)
    _table(spark, sf_dir, "part").repartition(2, "p_partkey").select(line).write.text(path)
    return path


def experiment_xml() -> Column:
    key, odd = _text("p_partkey"), c("p_partkey") % 2 == 1
    layout = F.when(c("p_partkey") % 3 == 0, "<SINGLE/>").otherwise(_join('<PAIRED NOMINAL_LENGTH="', _text("p_size"), '" NOMINAL_SDEV="2.50"/>'))
    strategy, vendor = F.when(odd, "RNA-Seq").otherwise("WGS"), F.when(odd, "ILLUMINA").otherwise("LS454")
    library = _join("<LIBRARY_NAME>lib ", key, "</LIBRARY_NAME><LIBRARY_STRATEGY>", strategy, "</LIBRARY_STRATEGY><LIBRARY_SELECTION>size fractionation</LIBRARY_SELECTION><LIBRARY_LAYOUT>", layout, "</LIBRARY_LAYOUT>")
    platform = _join("<PLATFORM><!-- no <VENDOR> --><", vendor, "><INSTRUMENT_MODEL>Seq &#x2B; ", _xml("p_brand"), "</INSTRUMENT_MODEL></", vendor, "></PLATFORM>")
    return _join('<EXPERIMENT accession="DRX', key, '"><TITLE>', _xml("p_name"), "</TITLE><DESIGN><DESIGN_DESCRIPTION/><LIBRARY_DESCRIPTOR>", library, "</LIBRARY_DESCRIPTOR></DESIGN>", platform, "</EXPERIMENT>")


def experiments(spark: SparkSession, sf_dir: str) -> str:
    """Tar archives of experiments from parts, one a task, every other one gzip without saying so; with members of other kinds."""
    path = workspace(spark)
    system, at = open_path(path)
    system.create_dir(at, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = [x for b in batches for x in b.column(0).to_pylist()]
        if texts:
            hidden, name = f"_{uuid.uuid4().hex}", f"part_{min(texts)[23:].partition(chr(34))[0]}.tar"
            with system.open_output_stream(f"{at}/{hidden}", compression=None) as raw, tarfile.open(fileobj=raw, mode="w|gz" if len(texts) % 2 else "w|") as tar:
                for i in range(0, len(texts), MEMBER_ROWS):
                    data = f"<EXPERIMENT_SET>{''.join(texts[i : i + MEMBER_ROWS])}</EXPERIMENT_SET>".encode()
                    for kind in ("experiment", "run"):
                        info = tarfile.TarInfo(f"DRA{i}/DRA{i}.{kind}.xml")
                        info.size = len(data)
                        tar.addfile(info, io.BytesIO(data))
            system.move(f"{at}/{hidden}", f"{at}/{name}")
        yield pa.RecordBatch.from_arrays([pa.array([len(texts)], pa.int64())], ["n"])

    _table(spark, sf_dir, "part").repartition(3, "p_partkey").select(experiment_xml().alias("value")).mapInArrow(run, "n long").count()
    return path


DUMPS = {"sra": sra, "biosample": biosample, "bioproject": bioproject, "sra-experiment": experiments}
