import gzip
import io
import json
import tarfile

import pytest

from tripleloom import vocab
from tripleloom.operators import graph, reconcile, sink, validate
from tripleloom.operators.specs import MAPPINGS
from tripleloom.sources import read_source

HEADER = "\t".join(["Accession", *["x"] * 19])


def row(accession, status, kind, links=("-",) * 5, updated="u", published="p"):
    f = ["-"] * 20
    f[0], f[1], f[2], f[3], f[4], f[6], f[7] = accession, "S1", status, updated, published, kind, "C"
    f[10], f[11], f[12], f[17], f[18] = links
    return "\t".join(f)


TSV = "\n".join(
    [
        HEADER,
        row("R1", "live", "RUN", ("X1", "-", "", "SAMD1", "PRJ1"), 'a"b', "-"),
        "",
        row("A1", "live", "ANALYSIS") + "\textra",
        row("S9", "suppressed", "NOTHING"),
        row("B1", "live", "BOOK"),
        "a\tb",
        row("T1", "live", "STUDY") + "\r",
    ]
)
BIOSAMPLE = """<?xml version="1.0"?><BioSampleSet>
<BioSample accession="SKIPPED"/><BioSample access="public" accession="SAMD1" submission_date="2001" last_update="" publication_date="2003">
<Ids><Id>1</Id></Ids><Description><Title>A &amp; "b"</Title></Description>
<Attributes><Attribute attribute_name="sample name" harmonized_name="sample_name" display_name="d">x\\y</Attribute>
<Attribute attribute_name="odd %é">two</Attribute><Attribute attribute_name="none"/><Attribute attribute_name="empty" harmonized_name="">v</Attribute></Attributes></BioSample>
<BioSample id="2"><Description><Title>no accession</Title></Description></BioSample>
<BioSample accession="SAMD3"><Description><Title></Title></Description><Attributes/></BioSample>
<BioSample accession="SAMD4"><Description><Title>&nope;</Title></Description></BioSample>
<BioSample accession="SAMD5"><Description><Title>cut"""
BIOPROJECT = """<PackageSet><Package><Project><Project><ProjectID><ArchiveID accession="PRJ1" archive="A"/></ProjectID>
<ProjectDescr><Name>n1</Name><Title>t1</Title><Description>d</Description><ProjectReleaseDate>2003-02-23</ProjectReleaseDate></ProjectDescr>
<ProjectType><ProjectTypeSubmission><Target><Organism taxID="9"><OrganismName>O</OrganismName></Organism></Target></ProjectTypeSubmission></ProjectType></Project>
<Submission submitted="2002-01-01"><Description><Organization><Name>not me</Name></Organization></Description></Submission></Project></Package>
<Package><Project><Project><ProjectDescr><Title>lost</Title></ProjectDescr></Project></Project></Package>
<Package><Project><Project><ProjectID><ArchiveID accession="PRJ2"/></ProjectID><ProjectDescr><Title>only title</Title></ProjectDescr></Project>
<Submission><Description><Organization><Name>not me</Name></Organization></Description></Submission></Project></Package></PackageSet>"""
EXPERIMENT = """<EXPERIMENT_SET><EXPERIMENT accession="DRX1" alias="a"><TITLE>Ti</TITLE><DESIGN><DESIGN_DESCRIPTION/><LIBRARY_DESCRIPTOR><LIBRARY_NAME>L "1"</LIBRARY_NAME>
<LIBRARY_STRATEGY>WGS</LIBRARY_STRATEGY><LIBRARY_SOURCE>GENOMIC</LIBRARY_SOURCE><LIBRARY_SELECTION>size fractionation</LIBRARY_SELECTION>
<LIBRARY_LAYOUT><PAIRED NOMINAL_LENGTH="300" NOMINAL_SDEV="25.5"/></LIBRARY_LAYOUT></LIBRARY_DESCRIPTOR></DESIGN>
<PLATFORM><LS454><INSTRUMENT_MODEL>454 GS FLX+</INSTRUMENT_MODEL></LS454></PLATFORM></EXPERIMENT>
<EXPERIMENT accession="DRX2"><DESIGN><LIBRARY_DESCRIPTOR><LIBRARY_LAYOUT><PAIRED NOMINAL_LENGTH="inf" NOMINAL_SDEV="1e7"></PAIRED></LIBRARY_LAYOUT></LIBRARY_DESCRIPTOR></DESIGN></EXPERIMENT>
<EXPERIMENT alias="none"><TITLE>x</TITLE></EXPERIMENT></EXPERIMENT_SET>"""


@pytest.fixture(scope="module")
def dumps(tmp_path_factory):
    d = tmp_path_factory.mktemp("dumps")
    (d / "sra.tab").write_text(TSV)
    (d / "bs.xml").write_text(BIOSAMPLE)
    (d / "bs.xml.gz").write_bytes(gzip.compress(BIOSAMPLE.encode()))
    (d / "bp.xml").write_text(BIOPROJECT)
    for name, mode in (("x.tar", "w"), ("x.tar.gz", "w:gz")):
        with tarfile.open(d / name, mode) as tar:
            for member, text in (("a/DRA1.experiment.xml", EXPERIMENT), ("a/DRA1.run.xml", EXPERIMENT), ("b/bad.experiment.xml", '<EXPERIMENT accession="Z"><TITLE></EXPERIMENT>')):
                info = tarfile.TarInfo(member)
                info.size = len(text.encode())
                tar.addfile(info, io.BytesIO(text.encode()))
    return d


def test_tsv(spark, dumps):
    got = read_source(spark, "sra", str(dumps / "sra.tab"))
    rows = {r.accession: r for r in got.records.collect()}
    assert set(rows) == {"R1", "A1", "T1"}
    assert (rows["R1"].updated, rows["R1"].published, rows["R1"].sample, rows["R1"].study, rows["R1"].biosample) == ('a"b', None, None, None, "SAMD1")
    assert rows["T1"].bioproject is None
    assert sorted((e.accession, e.error) for e in got.errors.collect()) == [("B1", "TsvParse"), ("a", "TsvParse")]


def test_sra_syntaxes(spark, dumps):
    m = MAPPINGS["sra"]()
    one = sink.render(m, read_source(spark, "sra", str(dumps / "sra.tab")).records.filter("accession = 'R1'")).first()
    assert one.ttl == (
        'insdc_sra:R1\n  a dra_ont:Run ;\n  dct:identifier "R1" ;\n  dct:modified "a\\"b"^^xsd:dateTime ;\n'
        "  rdfs:seeAlso <http://identifiers.org/insdc.sra/X1> ;\n  rdfs:seeAlso <http://identifiers.org/biosample/SAMD1> ;\n  rdfs:seeAlso <http://identifiers.org/bioproject/PRJ1> .\n\n"
    )
    lines = one.nt.splitlines()
    assert lines[0] == f"<{vocab.SRA}R1> <{vocab.RDF_TYPE}> <{vocab.DRA_ONT}Run> ." and len(lines) == 6
    assert lines[2] == f'<{vocab.SRA}R1> <{vocab.DCT}modified> "a\\"b"^^<{vocab.XSD}dateTime> .'
    data = json.loads(one.jsonld)
    assert list(data) == ["@context", "@type", "@id", "dct:identifier", "dct:modified", "rdfs:seeAlso"]
    assert one.jsonld == json.dumps(data, indent=2, ensure_ascii=False)
    assert data["dct:modified"] == {"@value": 'a"b', "@type": "xsd:dateTime"} and len(data["rdfs:seeAlso"]) == 3


@pytest.mark.parametrize("name", ["bs.xml", "bs.xml.gz"])
def test_biosample(spark, dumps, name):
    got = read_source(spark, "biosample", str(dumps / name))
    rows = {r.accession: r for r in got.records.collect()}
    assert set(rows) == {"SAMD1", "SAMD3"}
    assert rows["SAMD1"].title == 'A & "b"' and rows["SAMD3"].title is None and rows["SAMD3"].attributes == []
    assert [(a.attribute_name, a.harmonized_name, a["value"]) for a in rows["SAMD1"].attributes][2:] == [("none", None, None), ("empty", "", "v")]
    assert sorted(e.error for e in got.errors.collect()) == ["MissingAccession", "XmlParse", "XmlParse"]
    m = MAPPINGS["biosample"]()
    triples = m.triples(got.records)
    # SAMD1: type, identifier, 2 of the title, 3 dates (one empty, as it is given), 4 for each of 4 attributes
    assert triples.filter("s not like '%#%'").filter(f"s = '{vocab.BIOSAMPLE}SAMD1'").count() == 7 + 4
    assert triples.count() == 7 + 16 + 2
    assert triples.filter(f"o = '{vocab.BIOSAMPLE_PROPERTY}SAMD1#odd%20%25%C3%A9'").count() == 1
    shown = {r.ttl.split("\n")[0]: r for r in sink.render(m, got.records).collect()}
    assert "  :additionalProperty\n    <" in shown["idorg:SAMD1"].ttl and '  :value "x\\\\y" .\n' in shown["idorg:SAMD1"].ttl
    data = json.loads(shown["idorg:SAMD1"].jsonld)
    assert data["additionalProperty"][0] == {"@type": "PropertyValue", "@id": f"{vocab.BIOSAMPLE_PROPERTY}SAMD1#sample_name", "name": "sample_name", "value": "x\\y"}
    assert "additionalProperty" not in json.loads(shown["idorg:SAMD3"].jsonld)


def test_bioproject(spark, dumps):
    got = read_source(spark, "bioproject", str(dumps / "bp.xml"))
    rows = {r.accession: r.asDict() for r in got.records.collect()}
    assert rows["PRJ1"] == {"accession": "PRJ1", "name": "n1", "title": "t1", "description": "d", "organism_name": "O", "taxonomy_id": "9", "release_date": "2003-02-23", "submission_date": "2002-01-01"}
    assert rows["PRJ2"]["name"] is None and len(rows) == 2
    assert [e.error for e in got.errors.collect()] == ["MissingAccession"]
    label = MAPPINGS["bioproject"]().triples(got.records).filter(f"p = '{vocab.RDFS}label'")
    assert sorted(r.o for r in label.collect()) == ["n1", "only title"]
    assert graph.project_metadata(got.records).count() == 2


@pytest.mark.parametrize("name", ["x.tar", "x.tar.gz"])
def test_experiment(spark, dumps, name):
    got = read_source(spark, "sra-experiment", str(dumps / name))
    rows = {r.accession: r for r in got.records.collect()}
    assert set(rows) == {"DRX1", "DRX2"}
    r = rows["DRX1"]
    assert (r.platform, r.instrument_model, r.design_description, r.library_layout.kind, r.library_layout.nominal_sdev) == ("LS454", "454 GS FLX+", None, "PAIRED", 25.5)
    assert rows["DRX2"].library_layout.nominal_length is None and rows["DRX2"].library_layout.nominal_sdev == 1e7 and rows["DRX2"].platform is None
    assert sorted(e.error for e in got.errors.collect()) == ["MissingAccession", "XmlParse"]
    m = MAPPINGS["sra-experiment"]()
    shown = {x.ttl.split("\n")[0]: x for x in sink.render(m, got.records).collect()}
    ttl = shown["insdc_sra:DRX1"].ttl
    assert '  rdfs:label "DRX1: Ti" ;\n  dct:identifier "DRX1" ;\n  dra_ont:title "Ti" ;\n  dra_ont:platform [\n    a dra_ont:LS454 ;\n    dra_ont:instrumentModel <http://ddbj.nig.ac.jp/ontologies/dra/454_GS_FLX+>\n  ] ;' in ttl
    assert '    dra_ont:libraryLayout [\n    a dra_ont:PAIRED ;\n    dra_ont:nominalLength "300"^^xsd:decimal ;\n    dra_ont:nominalSdev "25.5"^^xsd:decimal\n  ]\n  ] .\n\n' in ttl
    nt = shown["insdc_sra:DRX1"].nt
    assert "_:DRX1_design" in nt and all(line.endswith(" .") for line in nt.splitlines())
    data = json.loads(shown["insdc_sra:DRX2"].jsonld)
    assert data["dra_ont:design"] == {"@type": "dra_ont:ExperimentDesign", "dra_ont:libraryLayout": {"@type": "dra_ont:PAIRED", "dra_ont:nominalSdev": {"@value": "10000000", "@type": "xsd:decimal"}}}
    assert graph.by_platform(got.records, "LS454").count() == 1 and graph.by_strategy(got.records, "WGS").count() == 1


@pytest.mark.parametrize("size, chunks", [(2, 2), (3, 1), (1, 3)])
def test_convert_and_validate(spark, dumps, tmp_path, size, chunks):
    out = str(tmp_path / "out")
    for _ in range(2):  # again over what is there
        m = sink.convert(spark, "sra", str(dumps / "sra.tab"), out, size)
    assert (m["total_chunks"], m["total_records"], m["records_skipped"]) == (chunks, 3, 2) and len(m["source_md5"]) == 32
    names = sorted(p.name for p in (tmp_path / "out/ttl").iterdir())
    assert names == [f"chunk_{i:04d}.ttl" for i in range(chunks)]
    records = [x for p in sorted((tmp_path / "out/jsonld").iterdir()) for x in json.loads(p.read_text())]
    assert [x["dct:identifier"] for x in records] == ["R1", "A1", "T1"]
    assert (tmp_path / "out/ttl/chunk_0000.ttl").read_text().startswith("@prefix insdc_sra: <")
    assert sink.load_progress(out)["records_processed"] == 3 and sink.load_progress(str(tmp_path)) is None
    assert spark.read.text(f"{out}/errors.log").filter("value LIKE 'TsvParse: %'").count() == 4
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["errors.log", "jsonld", "manifest.json", "nt", "progress.json", "ttl"]
    report = validate.validate(spark, out, "sra")
    assert (report.files, report.records, report.ok) == (2 * chunks, 6, True)
    (tmp_path / "out/nt/chunk_0000.nt").write_text("<a> <b> <c> .\n\n<a> <b> <c>\n")
    bad = validate.validate(spark, out, "sra")
    assert bad.error_count == 1 and [(r.line, r.message) for r in bad.errors.collect()] == [(3, "does not end with ' .'")]
    assert validate.validate(spark, str(tmp_path / "none"), "sra").files == 0


def test_convert_nothing(spark, tmp_path):
    (tmp_path / "e.tab").write_text(HEADER + "\n")
    m = sink.convert(spark, "sra", str(tmp_path / "e.tab"), str(tmp_path / "o"))
    assert (m["total_chunks"], m["total_records"]) == (0, 0)


def test_triples_equal_lines(spark, dumps):
    """The triple table, rendered line by line, is what the record renderer writes."""
    from tripleloom.operators.mapping import nt_lines

    for source, name in (("sra", "sra.tab"), ("biosample", "bs.xml"), ("bioproject", "bp.xml"), ("sra-experiment", "x.tar")):
        m, records = MAPPINGS[source](), read_source(spark, source, str(dumps / name)).records
        lines = sorted(r.line for r in nt_lines(m.triples(records)).collect())
        assert lines == sorted(line for r in sink.render(m, records).collect() for line in r.nt.splitlines())


def test_graph_queries(spark, dumps):
    records = read_source(spark, "sra", str(dumps / "sra.tab")).records
    triples = MAPPINGS["sra"]().triples(records).unionByName(MAPPINGS["biosample"]().triples(read_source(spark, "biosample", str(dumps / "bs.xml")).records))
    twice = triples.unionByName(triples)
    counts = {r["class"].rsplit("/", 1)[-1]: r.n for r in graph.type_counts(twice).collect()}
    assert counts == {"Run": 1, "Analysis": 1, "Study": 1, "BioSampleRecord": 2, "PropertyValue": 4}
    assert graph.triple_count(twice).first().n == triples.distinct().count()
    assert graph.crosslink_subjects(twice, vocab.BIOSAMPLE).first().n == 1
    assert graph.run_links(twice).collect()[0].bioproject == vocab.BIOPROJECT + "PRJ1"
    rows = graph.original_attributes(twice).collect()
    assert len(rows) == 4 and {r.sra_run for r in rows} == {vocab.SRA + "R1"}
    assert graph.spot_lookup(twice, vocab.SRA + "A1").count() == 4
    assert graph.class_count(twice, vocab.SCHEMA + "PropertyValue").first().n == 4
    run = vocab.DRA_ONT + "Run"
    assert validate.cardinality(twice, run, vocab.DCT + "issued").first().n == 0
    assert validate.cardinality(twice, run, vocab.DCT + "identifier").count() == 0
    assert validate.datatype(twice, run, vocab.DCT + "modified", vocab.XSD + "date").count() == 2
    assert validate.node_kind(twice, run, vocab.RDFS + "seeAlso", "iri").count() == 0
    assert validate.reference(triples, run, vocab.RDFS + "seeAlso", vocab.BIOSAMPLE_ONT + "BioSampleRecord").count() == 2


def test_reconcile(spark, dumps):
    records = read_source(spark, "sra-experiment", str(dumps / "x.tar")).records
    members = spark.createDataFrame([(EXPERIMENT,)], "value string")
    assert reconcile.count_tags(members) == 3 and reconcile.counts_agree(3, 2, 1) and not reconcile.counts_agree(10, 5)
    assert reconcile.live_rows(spark.read.text(str(dumps / "sra.tab")), "RUN") == 1
    m = MAPPINGS["sra-experiment"]()
    blocks = reconcile.turtle_blocks(records.select(m.turtle().alias("value")))
    written = blocks.selectExpr("replace(subject, 'insdc_sra:', '') AS accession", "block").select("accession", reconcile.block_field("block", "dra_ont:title").alias("title"), reconcile.block_field("block", "dra_ont:libraryName").alias("library_name"), reconcile.block_field("block", "dra_ont:librarySelection").alias("library_selection"))
    assert reconcile.field_fidelity(records, written, "accession", ["title", "library_name", "library_selection"]).count() == 0
    off = reconcile.field_fidelity(records, written.withColumn("title", written.accession), "accession", ["title"], sample=1).collect()
    assert [(r.accession, r.expected, r.found) for r in off] == [("DRX1", "Ti", "DRX1")]
    assert reconcile.pivot(m.triples(records), reconcile.PREDICATES).count() == 2


def test_stream(spark, dumps, tmp_path):
    from tripleloom.streaming.incremental import append_triples, stream_sra

    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.tab").write_text(TSV)
    for extra in ("", row("R7", "live", "RUN")):
        if extra:
            (tmp_path / "in/b.tab").write_text(extra)
        append_triples(stream_sra(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    assert {r["class"].rsplit("/", 1)[-1]: r.n for r in graph.type_counts(got).collect()} == {"Run": 2, "Analysis": 1, "Study": 1}


def test_validate_lists_every_error(spark, tmp_path):
    from tripleloom.operators.validate import validate

    path = tmp_path / "broken.nt"
    path.write_text("".join(f"<s{i}> <p> <o>\n" for i in range(2500)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")  # many splits of one file
    try:
        report = validate(spark, str(path), "sra")
        assert report.error_count == 2500 and sorted(r.line for r in report.errors.collect()) == list(range(1, 2501))
        assert {r.message for r in report.errors.collect()} == {"does not end with ' .'"}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("size", [7, 100, 5000])
def test_chunks_over_many_partitions(spark, tmp_path, size):
    """Chunk files hold the records in order, whatever partitions they come from."""
    rows = [row(f"R{i:05d}", "live", "RUN") for i in range(1234)]
    for k in range(5):
        (tmp_path / f"in{k}.tab").write_text("\n".join([HEADER, *rows[250 * k : 250 * (k + 1)]]))
    (tmp_path / "d").mkdir()
    for k in range(5):
        (tmp_path / f"in{k}.tab").rename(tmp_path / f"d/in{k}.tab")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        made = sink.convert(spark, "sra", str(tmp_path / "d"), str(tmp_path / "o"), size)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert made["total_records"] == 1234 and made["total_chunks"] == -(-1234 // size)
    counts, every = [], []
    for p in sorted((tmp_path / "o/jsonld").iterdir()):
        ids = [x["dct:identifier"] for x in json.loads(p.read_text())]
        nt = [x.split()[0][len(vocab.SRA) + 1 : -1] for x in p.parent.parent.joinpath("nt", p.stem + ".nt").read_text().splitlines() if vocab.RDF_TYPE in x]
        ttl = p.parent.parent.joinpath("ttl", p.stem + ".ttl").read_text()
        assert nt == ids and ttl.startswith("@prefix") and ttl.count("@prefix insdc_sra:") == 1 and [x[10:] for x in ttl.splitlines() if x.startswith("insdc_sra:")] == ids
        counts.append(len(ids))
        every += ids
    assert sorted(every) == [f"R{i:05d}" for i in range(1234)] and counts[:-1] == [size] * (len(counts) - 1)


def test_header_is_the_first_line_only(spark, tmp_path):
    (tmp_path / "a.tab").write_text("\n\n" + "\n".join([HEADER, "Accession\tshort", row("R1", "live", "RUN"), "Accession\t" + row("x", "live", "RUN").split("\t", 1)[1]]))
    got = read_source(spark, "sra", str(tmp_path / "a.tab"))
    assert sorted(r.accession for r in got.records.collect()) == ["Accession", "R1"]
    assert [r.message for r in got.errors.collect()] == ["expected 20 columns, got 2"]


def test_biosample_children_under_any_parent(spark, tmp_path):
    (tmp_path / "b.xml").write_text("""<S><BioSample accession="A1"><Other><Title>first</Title></Other><Description><Title>last</Title></Description><More><Attribute attribute_name="x"/><Attribute attribute_name="y" harmonized_name="h">v &amp; w</Attribute></More><Attributes><Attribute attribute_name="z">1</Attribute></Attributes></BioSample>
<BioSample accession="A2"><Description><Title>one</Title></Description><Names><Title>two</Title><Title></Title></Names></BioSample></S>""")
    rows = {r.accession: r for r in read_source(spark, "biosample", str(tmp_path / "b.xml")).records.collect()}
    assert rows["A1"].title == "last" and rows["A2"].title == "two"
    assert [(a.attribute_name, a.harmonized_name, a["value"]) for a in rows["A1"].attributes] == [("x", None, None), ("y", "h", "v & w"), ("z", None, "1")]


def test_experiments_against_another_parser(spark, tmp_path):
    """Fields by ElementTree, written without the scan's own rules."""
    from xml.etree import ElementTree

    from tripleloom.plans import dumps

    path = dumps.experiments(spark, "/root/testdata/sf0.001")
    want = {}
    for name in reconcile_files(path):
        with tarfile.open(name) as tar:
            for member in tar:
                if member.name.endswith(".experiment.xml"):
                    for e in ElementTree.parse(tar.extractfile(member)).getroot():
                        text = lambda x, e=e: (e.findtext(f".//{x}") or "").strip() or None
                        vendor, layout = next(iter(e.find("PLATFORM"))), next(iter(e.find(".//LIBRARY_LAYOUT")))
                        want[e.get("accession")] = (text("TITLE"), text("DESIGN_DESCRIPTION"), text("LIBRARY_NAME"), text("LIBRARY_STRATEGY"), text("LIBRARY_SELECTION"), vendor.tag, text("INSTRUMENT_MODEL"), layout.tag, layout.get("NOMINAL_LENGTH") and float(layout.get("NOMINAL_LENGTH")))
    rows = read_source(spark, "sra-experiment", path).records.collect()
    assert len(rows) == len(want) > 100
    for r in rows:
        assert want[r.accession] == (r.title, r.design_description, r.library_name, r.library_strategy, r.library_selection, r.platform, r.instrument_model, r.library_layout.kind, r.library_layout.nominal_length)


def reconcile_files(path):
    from tripleloom.sources.archive import files

    return [x.removeprefix("file://") for x in files(path)]


def test_scalars(spark):
    from pyspark.sql import functions as F

    from tripleloom.functions import scalars

    texts = ["a\0b", "\\", "\\\\n", 'q"\\"', "tab\t\r\n", "\\t", ""]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(scalars.unescape(scalars.escape("t"))).collect()] == texts
    numbers = spark.createDataFrame([(1e-20,), (2.0,), (0.1,), (1e22,), (123456789.125,)], "x double")
    assert [r[0] for r in numbers.select(scalars.decimal_text("x")).collect()] == ["0.00000000000000000001", "2", "0.1", "1" + "0" * 22, "123456789.125"]
    keys = spark.createDataFrame([("A-1",), ("A_1",), ("A1",), ("A2D1",), ("Ä",)], "k string")
    labels = [r[0] for r in keys.select(scalars.bnode(F.col("k"), "make")).collect()]
    assert len(set(labels)) == 5 and all(x.replace("_:", "").replace("_", "").isalnum() and x.isascii() for x in labels)


def test_statements_are_distinct(spark):
    m = MAPPINGS["sra"]()
    lines = spark.createDataFrame([("f", row("R1", "live", "RUN", ("X1", "X1", "-", "-", "-"))), ("f", row("R2", "live", "RUN")), ("f", row("R2", "live", "RUN")), ("f", row("R2", "live", "STUDY"))], "file string, value string")
    from tripleloom.sources.scan import sra_rows

    records = sra_rows(lines).records
    got = m.distinct_triples(records).collect()
    assert len(got) == len(set(got)) and set(got) == set(m.triples(records).collect())
    one = m.of_subject(records, vocab.SRA + "R2")
    assert {r.s for r in one.collect()} == {vocab.SRA + "R2"} and m.of_subject(records, "http://elsewhere/R2") is None
