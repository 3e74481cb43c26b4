"""Headline queries, timed once each after a warm-up of the session; prints one JSON line."""

from __future__ import annotations

import glob
import io
import json
import os
import shutil
import tarfile
import tempfile
import time

from pyspark.sql import functions as F

from tripleloom.operators import sink
from tripleloom.plans import registry
from tripleloom.session import session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINES = ["type_counts", "triple_count", "predicate_dist", "spot_lookup", "crosslink_distinct", "run_links", "seealso_unpivot", "nested_nodes", "turtle_blocks", "tsv_parse", "xml_extract", "field_fidelity", "shape_cardinality", "literal_escape"]
#: Records of the dumps that are converted.
RECORDS = {"sra": 1_000_000, "biosample": 100_000, "bioproject": 100_000, "sra-experiment": 100_000}


def timed(work) -> float:
    began = time.perf_counter()
    work()
    return round(time.perf_counter() - began, 3)


def dumps(spark, folder: str) -> dict[str, str]:
    """One file of RECORDS made from numbers for each source: TSV, XML, XML, and a tar archive of XML."""
    n = F.col("id").cast("string")
    fields = [F.lit("-")] * 20
    kinds = F.array(*[F.lit(k) for k in ("RUN", "SAMPLE", "EXPERIMENT", "STUDY")])
    fields[0], fields[2], fields[3], fields[4] = F.concat(F.lit("DRR"), n), F.lit("live"), F.lit("2022-09-23T10:09:59Z"), F.lit("2010-03-24T03:10:22Z")
    fields[6], fields[10], fields[17], fields[18] = F.get(kinds, (F.col("id") % 4).cast("int")), F.concat(F.lit("DRX"), n), F.concat(F.lit("SAMD"), n), F.lit("PRJDA38027")
    attribute = '<Attribute attribute_name="a%d" harmonized_name="name_%d">value %d of the sample</Attribute>'
    attributes = "".join(attribute % (i, i, i) for i in range(8))
    join = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    sample = join('<BioSample accession="SAMD', n, '" submission_date="2001-01-01" last_update="2002-01-01"><Description><Title>Sample ', n, f"</Title></Description><Attributes>{attributes}</Attributes></BioSample>")
    project = join('<Package><Project><Project><ProjectID><ArchiveID accession="PRJDB', n, '"/></ProjectID><ProjectDescr><Name>Project ', n, '</Name><Title>Sequencing of many things</Title><Description>Of no length to speak of</Description></ProjectDescr></Project><Submission submitted="2002-01-01"/></Project></Package>')
    library = "<LIBRARY_NAME>lib</LIBRARY_NAME><LIBRARY_STRATEGY>WGS</LIBRARY_STRATEGY><LIBRARY_SOURCE>GENOMIC</LIBRARY_SOURCE><LIBRARY_SELECTION>RANDOM</LIBRARY_SELECTION><LIBRARY_LAYOUT><PAIRED NOMINAL_LENGTH=\"300\"/></LIBRARY_LAYOUT>"
    experiment = join('<EXPERIMENT accession="DRX', n, '"><TITLE>Experiment ', n, f"</TITLE><DESIGN><DESIGN_DESCRIPTION>none</DESIGN_DESCRIPTION><LIBRARY_DESCRIPTOR>{library}</LIBRARY_DESCRIPTOR></DESIGN><PLATFORM><ILLUMINA><INSTRUMENT_MODEL>Genome Analyzer</INSTRUMENT_MODEL></ILLUMINA></PLATFORM></EXPERIMENT>")
    shown = {"sra": F.concat_ws("\t", *fields), "biosample": sample, "bioproject": project, "sra-experiment": experiment}
    out = {}
    for source, line in shown.items():
        spark.range(RECORDS[source]).select(line).write.text(f"{folder}/{source}_parts")
        out[source] = f"{folder}/{source}.{'tar' if source == 'sra-experiment' else 'txt'}"
        parts = sorted(glob.glob(f"{folder}/{source}_parts/*.txt"))
        if source != "sra-experiment":
            with open(out[source], "wb") as whole:
                for part in parts:
                    with open(part, "rb") as f:
                        shutil.copyfileobj(f, whole, 1 << 20)
            continue
        with tarfile.open(out[source], "w") as tar:
            for k, part in enumerate(parts):
                with open(part, "rb") as f:
                    lines = f.read().split(b"\n")
                for at in range(0, len(lines), 100):
                    data = b"<EXPERIMENT_SET>" + b"\n".join(lines[at : at + 100]) + b"</EXPERIMENT_SET>"
                    info = tarfile.TarInfo(f"DRA{k}/DRA{at}.experiment.xml")
                    info.size = len(data)
                    tar.addfile(info, io.BytesIO(data))
    return out


def main() -> None:
    spark = session(spark__master=f"local[{CPUS}]", spark__driver__memory="8g", spark__sql__shuffle__partitions=CPUS, spark__ui__enabled="false", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    registry.type_counts(spark, SF_DIR).count()
    times = {name: timed(lambda name=name: registry.QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()) for name in HEADLINES}
    rates = {}
    with tempfile.TemporaryDirectory() as folder:
        for source, path in dumps(spark, folder).items():
            out = f"{folder}/out_{source}"
            times[f"convert_{source}"] = timed(lambda source=source, path=path, out=out: sink.convert(spark, source, path, out))
            rates[source] = {"records": RECORDS[source], "records_per_s": round(RECORDS[source] / times[f"convert_{source}"])}
            shutil.rmtree(out)
    print(json.dumps({"metric": "headline queries and conversions, total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": SF_DIR.rsplit("sf", 1)[-1], "cpus": int(CPUS), "rates": rates}))


if __name__ == "__main__":
    main()
