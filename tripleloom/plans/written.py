"""Queries that go through files: dumps are written, scanned, converted, checked and queried back."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import vocab
from ..functions import scalars as S
from ..operators import graph, reconcile, sink, validate
from ..operators.mapping import nt_lines
from ..operators.specs import MAPPINGS
from ..sources import read_source
from ..sources.archive import files, open_path
from . import dumps
from .registry import c, query, table, triples_of

CHUNK = 500
_NULL = "CAST(NULL AS VARCHAR)"

# the dumps' records in SQL
_KINDS = " ".join(f"WHEN {i} THEN '{k}'" for i, k in enumerate(dumps.KINDS))
_DAY = "strftime(o_orderdate, '%Y-%m-%d') || 'T00:00:00Z'"
_SRA = f"""SELECT 'DRR' || o_orderkey AS accession, CASE o_orderkey % {len(dumps.KINDS)} {_KINDS} END AS sra_type, {_DAY} AS updated,
CASE WHEN o_orderkey % 5 <> 0 THEN {_DAY} END AS published, 'DRX' || o_custkey AS experiment, 'SAMD' || o_custkey AS biosample,
CASE WHEN o_orderkey % 2 = 0 THEN 'PRJDB' || o_custkey END AS bioproject FROM orders WHERE o_orderstatus <> 'P' AND o_orderkey % 89 <> 0 AND o_orderkey % {len(dumps.KINDS)} <> {len(dumps.KINDS) - 1}"""
_SRA_BAD = f"""SELECT 'DRR' || o_orderkey AS accession, 'expected 20 columns, got 3' AS message FROM orders WHERE o_orderkey % 89 = 0
UNION ALL SELECT 'DRR' || o_orderkey, 'unknown type: BOOK' FROM orders WHERE o_orderkey % 89 <> 0 AND o_orderstatus <> 'P' AND o_orderkey % {len(dumps.KINDS)} = {len(dumps.KINDS) - 1}"""
_SAMPLES = "SELECT c_custkey, 'SAMD' || c_custkey AS accession, c_name || ' & co' AS title, c_mktsegment FROM customer WHERE c_custkey % 50 <> 0"
_ATTRIBUTES = f"""SELECT accession, title, 'market segment' AS attribute_name, 'segment' AS harmonized_name, c_mktsegment AS value FROM ({_SAMPLES})
UNION ALL SELECT accession, title, 'odd "name" %', {_NULL}, 'x' FROM ({_SAMPLES}) UNION ALL SELECT accession, title, 'none', {_NULL}, {_NULL} FROM ({_SAMPLES})"""
_PROJECTS = "SELECT 'PRJDB' || p_partkey AS accession, CASE WHEN p_partkey % 3 <> 0 THEN p_brand END AS name, p_name AS title, p_type AS description, '2002-01-01' AS submission_date FROM part WHERE p_partkey % 41 <> 0"
_EXPERIMENTS = """SELECT 'DRX' || p_partkey AS accession, p_name AS title, 'lib ' || p_partkey AS library_name, CASE WHEN p_partkey % 2 = 1 THEN 'RNA-Seq' ELSE 'WGS' END AS library_strategy, 'size fractionation' AS library_selection,
CASE WHEN p_partkey % 2 = 1 THEN 'ILLUMINA' ELSE 'LS454' END AS platform, 'Seq + ' || p_brand AS instrument_model, CASE WHEN p_partkey % 3 = 0 THEN 'SINGLE' ELSE 'PAIRED' END AS kind,
CASE WHEN p_partkey % 3 <> 0 THEN CAST(p_size AS DOUBLE) END AS nominal_length, CASE WHEN p_partkey % 3 <> 0 THEN 2.5::DOUBLE END AS nominal_sdev FROM part"""


def _scan(spark, d, source: str, **options):
    return read_source(spark, source, dumps.DUMPS[source](spark, d, **options))


# --- scans ---------------------------------------------------------------------------------------------


@query(_SRA)
def scan_sra(spark, d):
    return _scan(spark, d, "sra").records.select("accession", "sra_type", "updated", "published", "experiment", "biosample", "bioproject")


@query(_SRA_BAD)
def scan_sra_errors(spark, d):
    return _scan(spark, d, "sra").errors.select("accession", "message")


def _attributes(parsed):
    return parsed.records.select("accession", "title", F.inline("attributes")).select("accession", "title", "attribute_name", "harmonized_name", "value")


@query(_ATTRIBUTES)
def scan_biosample(spark, d):
    return _attributes(_scan(spark, d, "biosample"))


@query(_ATTRIBUTES)
def scan_biosample_gzip(spark, d):
    return _attributes(_scan(spark, d, "biosample", codec="gzip"))


@query("SELECT 'MissingAccession' AS error, count(*) AS n FROM customer WHERE c_custkey % 50 = 0 HAVING count(*) > 0")
def scan_biosample_errors(spark, d):
    return _scan(spark, d, "biosample").errors.groupBy("error").agg(F.count("*").alias("n"))


@query(_PROJECTS)
def scan_bioproject(spark, d):
    return _scan(spark, d, "bioproject").records.select("accession", "name", "title", "description", "submission_date")


@query(_EXPERIMENTS)
def scan_experiment(spark, d):
    rows = _scan(spark, d, "sra-experiment").records
    return rows.select("accession", "title", "library_name", "library_strategy", "library_selection", "platform", "instrument_model", "library_layout.*")


# --- conversion ------------------------------------------------------------------------------------------


def _converted(spark, d, source: str) -> tuple[str, dict]:
    out = dumps.workspace(spark)
    return out, sink.convert(spark, source, dumps.DUMPS[source](spark, d), out, CHUNK)


def _line(p: str, o: str, datatype: str = "") -> str:
    return f"SELECT '<{vocab.SRA}' || accession || '> <{p}> \"' || {o} || '\"{datatype} .' AS line FROM r WHERE {o} IS NOT NULL"


_CLASS = "CASE sra_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in vocab.SRA_CLASSES.items()) + " END"
_DATE = f"^^<{vocab.XSD}dateTime>"
_SEE = " UNION ALL ".join(f"SELECT '<{vocab.SRA}' || accession || '> <{vocab.RDFS}seeAlso> <{ns}' || {k} || '> .' FROM r WHERE {k} IS NOT NULL" for k, ns in (("experiment", vocab.SRA), ("biosample", vocab.BIOSAMPLE), ("bioproject", vocab.BIOPROJECT)))
_SRA_LINES = f"""WITH r AS ({_SRA}) SELECT '<{vocab.SRA}' || accession || '> <{vocab.RDF_TYPE}> <{vocab.DRA_ONT}' || {_CLASS} || '> .' AS line FROM r
UNION ALL {_line(vocab.DCT + "identifier", "accession")} UNION ALL {_line(vocab.DCT + "issued", "published", _DATE)} UNION ALL {_line(vocab.DCT + "modified", "updated", _DATE)} UNION ALL {_SEE}"""


@query(_SRA_LINES)
def convert_ntriples(spark, d):
    """Lines of the N-Triples chunks."""
    out, _ = _converted(spark, d, "sra")
    return spark.read.text(f"{out}/nt").select(c("value").alias("line"))


@query(f"SELECT 'idorg:' || c_custkey AS id, title AS label, c_mktsegment AS first_value, 3 AS properties FROM ({_SAMPLES})".replace("'idorg:' || c_custkey", f"'{vocab.BIOSAMPLE}' || accession"))
def convert_jsonld(spark, d):
    """Objects of the JSON-LD chunks."""
    out, _ = _converted(spark, d, "biosample")
    rows = spark.read.option("multiLine", True).json(f"{out}/jsonld")
    return rows.select(c("`@id`").alias("id"), c("`rdfs:label`").alias("label"), F.get("additionalProperty", F.lit(0))["value"].alias("first_value"), F.size("additionalProperty").alias("properties"))


@query(f"SELECT accession, title, library_name, replace(library_selection, ' ', '_') AS library_selection, replace(instrument_model, ' ', '_') AS instrument_model FROM ({_EXPERIMENTS})")
def convert_turtle(spark, d):
    """Fields read back from the blocks of the Turtle chunks."""
    out, _ = _converted(spark, d, "sra-experiment")
    blocks = reconcile.turtle_blocks(spark.read.option("lineSep", "\n\n").text(f"{out}/ttl"))
    fields = {"accession": "dct:identifier", "title": "dra_ont:title", "library_name": "dra_ont:libraryName", "library_selection": "dra_ont:librarySelection", "instrument_model": "dra_ont:instrumentModel"}
    return blocks.select(*[reconcile.block_field("block", p).alias(n) for n, p in fields.items()])


@query(f"""WITH n AS (SELECT count(*) AS n FROM ({_PROJECTS})), k AS (SELECT unnest(range(CAST(ceil(n / {CHUNK}.0) AS BIGINT))) AS chunk, n FROM n)
SELECT 'chunk_' || lpad(CAST(chunk AS VARCHAR), 4, '0') || '.' || kind AS name, CAST(least({CHUNK}, n - chunk * {CHUNK}) AS BIGINT) AS records, CAST(0 AS BIGINT) AS errors FROM k, (VALUES ('ttl'), ('nt')) v(kind)""")
def convert_chunks(spark, d):
    """Records and errors of every chunk file, by the validator."""
    out, _ = _converted(spark, d, "bioproject")
    paths = [x for kind in ("ttl", "nt") for x in files(f"{out}/{kind}")]
    counted, _ = validate.validate_files(spark, paths, "bioproject")
    return counted.select(F.substring_index("path", "/", -1).alias("name"), "records", "errors")


_COUNTS = {"sra": (_SRA, _SRA_BAD), "biosample": (_SAMPLES, "SELECT 1 AS x FROM customer WHERE c_custkey % 50 = 0"), "bioproject": (_PROJECTS, "SELECT 1 AS x FROM part WHERE p_partkey % 41 = 0"), "sra-experiment": (_EXPERIMENTS, "SELECT 1 AS x FROM part WHERE false")}
_MANIFESTS = " UNION ALL ".join(f"SELECT '{s}' AS source, CAST(ceil(r.n / {CHUNK}.0) AS BIGINT) AS total_chunks, r.n AS total_records, e.n AS records_skipped FROM (SELECT count(*) AS n FROM ({good})) r, (SELECT count(*) AS n FROM ({bad})) e" for s, (good, bad) in _COUNTS.items())


@query(f"WITH m AS ({_MANIFESTS}) SELECT * FROM m UNION ALL SELECT 'all', CAST(sum(total_chunks) AS BIGINT), CAST(sum(total_records) AS BIGINT), CAST(sum(records_skipped) AS BIGINT) FROM m")
def convert_summary(spark, d):
    """The manifests of all four sources, and their sum."""
    return sink.summary(spark, {source: _converted(spark, d, source)[0] for source in dumps.DUMPS})


# --- checks and reconciliation ---------------------------------------------------------------------------


@query("SELECT CAST(c_custkey % 10 AS VARCHAR) || '.nt' AS name, \"does not end with ' .'\" AS message, count(*) AS n FROM customer WHERE c_custkey % 50 = 0 GROUP BY ALL".replace("\"does not end with ' .'\"", "'does not end with '' .'''"))
def validate_nt(spark, d):
    """Errors of N-Triples lines of which a part has lost its full stop."""
    lines = nt_lines(triples_of(spark, d, "customer", vocab.RDF_TYPE))
    key = F.regexp_extract("line", "/([0-9]+)>", 1).cast("long")
    shown = lines.select(F.concat((key % 10).cast("string"), F.lit(".nt")).alias("path"), F.when(key % 50 == 0, F.regexp_replace("line", r" \.$", "")).otherwise(c("line")).alias("value"))
    found = validate.checked_lines(shown, "sra").select(c("path").alias("name"), F.explode("messages").alias("message"))
    return found.groupBy("name", "message").agg(F.count("*").alias("n"))


@query(f"SELECT count(*) AS records, count(*) FILTER (WHERE number % 20 = 0) + count(*) FILTER (WHERE number % 31 = 0) AS errors FROM (SELECT CAST(substr(accession, 6) AS BIGINT) AS number FROM ({_PROJECTS}))")
def validate_ttl(spark, d):
    """A folder of Turtle with empty identifiers and odd subjects, written and checked."""
    key = F.regexp_extract("accession", "([0-9]+)$", 1).cast("long")
    block = MAPPINGS["bioproject"]().turtle()
    block = F.when(key % 20 == 0, F.regexp_replace(block, 'dct:identifier "[^"]*"', 'dct:identifier ""')).otherwise(block)
    block = F.when(key % 31 == 0, F.regexp_replace(block, "^idorg_bp:", "idorg_bp:X")).otherwise(block)
    path = dumps.workspace(spark)
    _scan(spark, d, "bioproject").records.select(block.alias("value")).write.text(f"{path}/parts")
    rows = [x for x in files(f"{path}/parts") if x.endswith(".txt")]
    lines = validate._lines(spark, rows).withColumn("path", F.concat("path", F.lit(".ttl")))
    found = validate.checked_lines(lines, "bioproject")
    return found.agg(F.count_if("is_record").alias("records"), F.sum(F.size("messages")).alias("errors"))


@query("SELECT 'a.nt' AS name, line FROM (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) AS line FROM customer) WHERE c_custkey % 50 = 0")
def validate_lines(spark, d):
    """Line numbers of the errors of a file of one line a customer."""
    path = dumps.workspace(spark)
    line = F.concat(F.lit("<s> <p> <o>"), F.when(c("c_custkey") % 50 == 0, "").otherwise(" ."))
    table(spark, d, "customer").orderBy("c_custkey").coalesce(1).select(line).write.text(path)
    system, at = open_path(path)
    system.move(open_path(next(x for x in files(path) if x.endswith(".txt")))[1], f"{at}/a.nt")
    _, errors = validate.validate_files(spark, [f"{path}/a.nt"], "sra")
    return errors.select(F.substring_index("path", "/", -1).alias("name"), F.col("line").cast("long").alias("line"))


@query(f"SELECT count(*) + (SELECT count(*) FROM part WHERE false) AS source_rows, count(*) AS written, true AS agree FROM ({_EXPERIMENTS})")
def reconcile_counts(spark, d):
    """Opening tags of the members, against the manifest of their conversion."""
    from ..sources.archive import register

    path, out = dumps.experiments(spark, d), dumps.workspace(spark)
    made = sink.convert(spark, "sra-experiment", path, out, CHUNK)
    register(spark)
    tags = reconcile.count_tags(spark.read.format("tar_members").option("suffix", ".experiment.xml").load(path))
    agree = reconcile.counts_agree(tags, made["total_records"], made["records_skipped"])
    return spark.createDataFrame([(tags, made["total_records"], agree)], "source_rows long, written long, agree boolean")


@query(f"SELECT sra_type AS kind, count(*) AS live FROM ({_SRA}) WHERE sra_type IN ('RUN', 'EXPERIMENT') GROUP BY sra_type")
def reconcile_live(spark, d):
    """Live rows of two types, counted on the dump's own lines."""
    lines = spark.read.text(dumps.sra(spark, d))
    return spark.createDataFrame([(k, reconcile.live_rows(lines, k)) for k in ("RUN", "EXPERIMENT")], "kind string, live long")


# --- saved templates ----------------------------------------------------------------------------------------


@query(f"""SELECT '{vocab.BIOSAMPLE}' || a.accession AS biosample, '{vocab.SRA}' || r.accession AS sra_run, name, coalesce(value, '') AS value
FROM (SELECT accession, coalesce(harmonized_name, attribute_name) AS name, value FROM ({_ATTRIBUTES})) a LEFT JOIN (SELECT accession, biosample FROM ({_SRA}) WHERE sra_type = 'RUN') r ON r.biosample = a.accession""")
def original_attributes(spark, d):
    """Attributes of samples, and the runs that link to them."""
    triples = None
    for source in ("biosample", "sra"):
        one = MAPPINGS[source]().triples(_scan(spark, d, source).records)
        triples = one if triples is None else triples.unionByName(one)
    return graph.original_attributes(triples).select("biosample", "sra_run", "name", "value")


@query(f"SELECT accession, title, coalesce(name, title) AS label, submission_date FROM ({_PROJECTS})")
def project_metadata(spark, d):
    return graph.project_metadata(_scan(spark, d, "bioproject").records).select("accession", "title", "label", "submission_date")


@query(f"SELECT accession, title, platform, instrument_model, library_name, library_strategy, kind AS library_layout FROM ({_EXPERIMENTS})")
def record_metadata(spark, d):
    return graph.experiment_metadata(_scan(spark, d, "sra-experiment").records).select("accession", "title", "platform", "instrument_model", "library_name", "library_strategy", "library_layout")


@query(f"SELECT accession, title FROM ({_EXPERIMENTS}) WHERE platform = 'LS454'")
def by_platform(spark, d):
    return graph.by_platform(_scan(spark, d, "sra-experiment").records, "LS454").select("accession", "title")


@query(f"SELECT accession, title FROM ({_EXPERIMENTS}) WHERE library_strategy = 'RNA-Seq'")
def by_strategy(spark, d):
    return graph.by_strategy(_scan(spark, d, "sra-experiment").records, "RNA-Seq").select("accession", "title")


@query(f"SELECT 'DRX' || p_partkey AS accession, 'title' AS field, p_name AS expected, 'other' AS found FROM part WHERE p_partkey % 10 = 0")
def block_fidelity(spark, d):
    """Records against fields of their Turtle blocks, some of them changed on the way."""
    records = _scan(spark, d, "sra-experiment").records
    blocks = records.select(MAPPINGS["sra-experiment"]().turtle().alias("block"))
    get = lambda p: reconcile.block_field("block", p)
    accession = get("dct:identifier")
    title = F.when(F.regexp_extract(accession, "([0-9]+)$", 1).cast("long") % 10 == 0, "other").otherwise(get("dra_ont:title"))
    written = blocks.select(accession.alias("accession"), title.alias("title"), get("dra_ont:libraryName").alias("library_name"), get("dra_ont:librarySelection").alias("library_selection"))
    return reconcile.field_fidelity(records, written, "accession", ["title", "library_name", "library_selection"])


@query("SELECT accession, text FROM (VALUES ('A-1', 'A_2D1'), ('A_1', 'A_5F1'), ('é', '_C3_A9')) v(accession, text)")
def blank_node_labels(spark, d):
    """Labels of accessions with other characters, which stay apart."""
    rows = spark.createDataFrame([("A-1",), ("A_1",), ("é",)], "accession string")
    return rows.select("accession", F.regexp_extract(S.bnode("accession", "x"), "^_:(.*)_x$", 1).alias("text"))


