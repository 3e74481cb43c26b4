"""The inventory's operators on the driver's tables: each a plan, and the SQL that must agree with it.

The star schema stands for the record sources: orders, customers, parts and line items are mapped to
triples by the same :class:`~tripleloom.operators.mapping.Mapping` as the dumps.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import vocab
from ..functions import scalars as S
from ..operators import graph, reconcile, validate
from ..operators.mapping import Links, Mapping, Node, Term, Text, nt_lines
from ..operators.sink import number_rows
from ..sources import scan

NS = "http://example.org/"
PREFIXES = {"order": NS + "order/", "customer": NS + "customer/", "part": NS + "part/", "supplier": NS + "supplier/", "nation": NS + "nation/", "item": NS + "item/", "ont": NS + "ont/", "dct": vocab.DCT, "rdfs": vocab.RDFS, "xsd": vocab.XSD}
c = F.col

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text(name: str) -> Column:
    return c(name).cast("string")


# --- mappings of the star schema ---------------------------------------------------------------


def _mapping(source: str, prefix: str, key: Column, cls: Column, *statements, having=None) -> Mapping:
    return Mapping(source, PREFIXES, prefix, key, ("ont", cls), statements, {"ont": NS + "ont/", "dct": vocab.DCT, "rdfs": vocab.RDFS, "xsd": vocab.XSD}, having=having)


def _numbered(*columns: str):
    """Keys of numbers as comparisons of the columns themselves, which a scan can use."""

    def having(key: str) -> Column:
        parts = key.split("-")
        if len(parts) != len(columns) or any(not p.isdecimal() or p != str(int(p)) for p in parts):
            return F.lit(False)
        out = F.lit(True)
        for name, p in zip(columns, parts, strict=True):
            out = out & (c(name) == int(p))
        return out

    return having


STATUS = {"F": "FilledOrder", "O": "OpenOrder", "P": "PendingOrder"}


def orders_mapping() -> Mapping:
    links = (S.iri(NS + "customer/", text("o_custkey")),)
    return _mapping("orders", "order", text("o_orderkey"), S.lookup("o_orderstatus", STATUS), Text("dct:identifier", text("o_orderkey")), Text("dct:issued", F.date_format("o_orderdate", "yyyy-MM-dd"), "xsd:date"), Term("ont:priority", "ont", S.uri_local("o_orderpriority")), Links("rdfs:seeAlso", links), having=_numbered("o_orderkey"))


def customer_mapping() -> Mapping:
    links = (S.iri(NS + "nation/", text("c_nationkey")),)
    return _mapping("customer", "customer", text("c_custkey"), F.lit("Customer"), Text("dct:identifier", text("c_custkey")), Text("rdfs:label", S.nonempty("c_name")), Text("ont:segment", c("c_mktsegment")), Links("rdfs:seeAlso", links), having=_numbered("c_custkey"))


def part_mapping() -> Mapping:
    return _mapping("part", "part", text("p_partkey"), F.lit("Part"), Text("rdfs:label", S.composed_label(text("p_partkey"), "p_name")), Text("dct:identifier", text("p_partkey")), Text("ont:price", S.decimal_text("p_retailprice"), "xsd:decimal"), having=_numbered("p_partkey"))


def nested_mapping() -> Mapping:
    """Parts with a node for their make, and in it, for odd sizes, one for their size."""
    odd = F.when(c("p_size") % 2 == 1, text("p_size"))
    size = Node("ont:size", "size", ("ont", F.lit("Size")), (Text("ont:value", odd, "xsd:decimal"),), (odd,))
    make = Node("ont:make", "make", ("ont", S.uri_local("p_brand")), (Term("ont:kind", "ont", S.uri_local("p_type")), size), (c("p_brand"), c("p_type")))
    return _mapping("part", "part", text("p_partkey"), F.lit("Part"), Text("dct:identifier", text("p_partkey")), make)


def lineitem_mapping() -> Mapping:
    key = F.concat_ws("-", text("l_orderkey"), text("l_linenumber"))
    return _mapping("lineitem", "item", key, F.lit("LineItem"), Text("dct:identifier", key), Links("rdfs:seeAlso", lineitem_links()), having=_numbered("l_orderkey", "l_linenumber"))


def lineitem_links() -> tuple[Column, ...]:
    return (S.iri(NS + "order/", text("l_orderkey")), S.iri(NS + "part/", text("l_partkey")), S.iri(NS + "supplier/", text("l_suppkey")))


MAPPED = {"orders": orders_mapping, "customer": customer_mapping, "part": part_mapping, "lineitem": lineitem_mapping}


def triples_of(spark: SparkSession, sf_dir: str, name: str, *predicates: str) -> DataFrame:
    return MAPPED[name]().triples(table(spark, sf_dir, name), set(predicates) or None)


def all_triples(spark: SparkSession, sf_dir: str, *names: str, predicates: tuple[str, ...] = ()) -> DataFrame:
    out = None
    for name in names or MAPPED:
        one = triples_of(spark, sf_dir, name, *predicates)
        out = one if out is None else out.unionByName(one)
    return out


def all_statements(spark: SparkSession, sf_dir: str, *predicates: str) -> DataFrame:
    """The triples of all mappings, each once; subjects of different mappings are in different namespaces."""
    parts = [MAPPED[name]().distinct_triples(table(spark, sf_dir, name), set(predicates) or None) for name in MAPPED]
    return reduce(DataFrame.unionByName, parts)


def _sql(source: str, s: str, cls: str, *rows: tuple[str, str, str, str | None]) -> str:
    """Triples as a union: (predicate, object, kind, datatype) each, rows without an object left out."""
    parts = []
    for p, o, kind, datatype in ((vocab.RDF_TYPE, cls, "iri", None), *rows):
        dt = f"'{datatype}'" if datatype else "CAST(NULL AS VARCHAR)"
        parts.append(f"SELECT '{source}' AS source, {s} AS s, '{p}' AS p, {o} AS o, '{kind}' AS o_kind, {dt} AS o_datatype FROM {source} WHERE ({o}) IS NOT NULL")
    return "\nUNION ALL ".join(parts)


def _local_sql(x: str) -> str:
    return f"replace(trim({x}), ' ', '_')"


_KEY = "CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR)"
_DEC = "CASE WHEN {x} = trunc({x}) THEN CAST(CAST({x} AS BIGINT) AS VARCHAR) ELSE CAST({x} AS VARCHAR) END"
_ISA = " ".join(f"WHEN '{k}' THEN '{NS}ont/{v}'" for k, v in STATUS.items())
_TRIPLES = {
    "orders": _sql(
        "orders",
        f"'{NS}order/' || o_orderkey",
        f"CASE o_orderstatus {_ISA} END",
        (vocab.DCT + "identifier", "CAST(o_orderkey AS VARCHAR)", "literal", None),
        (vocab.DCT + "issued", "strftime(o_orderdate, '%Y-%m-%d')", "literal", vocab.XSD + "date"),
        (NS + "ont/priority", f"'{NS}ont/' || {_local_sql('o_orderpriority')}", "iri", None),
        (vocab.RDFS + "seeAlso", f"'{NS}customer/' || o_custkey", "iri", None),
    ),
    "customer": _sql(
        "customer",
        f"'{NS}customer/' || c_custkey",
        f"'{NS}ont/Customer'",
        (vocab.DCT + "identifier", "CAST(c_custkey AS VARCHAR)", "literal", None),
        (vocab.RDFS + "label", "nullif(nullif(c_name, ''), '-')", "literal", None),
        (NS + "ont/segment", "c_mktsegment", "literal", None),
        (vocab.RDFS + "seeAlso", f"'{NS}nation/' || c_nationkey", "iri", None),
    ),
    "part": _sql(
        "part",
        f"'{NS}part/' || p_partkey",
        f"'{NS}ont/Part'",
        (vocab.RDFS + "label", "p_partkey || ': ' || p_name", "literal", None),
        (vocab.DCT + "identifier", "CAST(p_partkey AS VARCHAR)", "literal", None),
        (NS + "ont/price", _DEC.format(x="p_retailprice"), "literal", vocab.XSD + "decimal"),
    ),
    "lineitem": _sql(
        "lineitem",
        f"'{NS}item/' || {_KEY}",
        f"'{NS}ont/LineItem'",
        (vocab.DCT + "identifier", _KEY, "literal", None),
        (vocab.RDFS + "seeAlso", f"'{NS}order/' || l_orderkey", "iri", None),
        (vocab.RDFS + "seeAlso", f"'{NS}part/' || l_partkey", "iri", None),
        (vocab.RDFS + "seeAlso", f"'{NS}supplier/' || l_suppkey", "iri", None),
    ),
}
_ALL = "WITH t AS (SELECT DISTINCT s, p, o, o_kind, o_datatype FROM (" + "\nUNION ALL ".join(_TRIPLES.values()) + "))\n"
_MULTI = "WITH t AS (" + "\nUNION ALL ".join(_TRIPLES.values()) + ")\n"


# --- filters and row validity ----------------------------------------------------------------------


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def status_filter(spark, d):
    return table(spark, d, "orders").filter(c("o_orderstatus") == "F").select("o_orderkey", "o_custkey", "o_totalprice")


@query("SELECT o_orderkey, nullif(nullif(CASE WHEN o_orderkey % 3 = 0 THEN '-' WHEN o_orderkey % 3 = 1 THEN '' ELSE o_orderpriority END, ''), '-') AS value FROM orders")
def null_normalize(spark, d):
    raw = F.when(c("o_orderkey") % 3 == 0, "-").when(c("o_orderkey") % 3 == 1, "").otherwise(c("o_orderpriority"))
    return table(spark, d, "orders").select("o_orderkey", S.nonempty(raw).alias("value"))


EVENT_CLASSES = {"signup": "Signup", "purchase": "Purchase", "view": "View", "click": "Click"}


@query("SELECT event_id, CASE event_type WHEN 'signup' THEN 'Signup' WHEN 'purchase' THEN 'Purchase' WHEN 'view' THEN 'View' WHEN 'click' THEN 'Click' END AS class FROM events")
def enum_to_class(spark, d):
    return table(spark, d, "events").select("event_id", S.lookup("event_type", EVENT_CLASSES).alias("class"))


@query("SELECT event_id, CASE WHEN event_type NOT IN ('signup', 'purchase', 'view', 'click') THEN 'unknown type: ' || event_type WHEN user_id IS NULL THEN 'missing user' END AS error FROM events WHERE event_type NOT IN ('signup', 'purchase', 'view', 'click') OR user_id IS NULL")
def error_split(spark, d):
    unknown = S.lookup("event_type", EVENT_CLASSES).isNull()
    error = F.when(unknown, F.concat(F.lit("unknown type: "), c("event_type"))).when(c("user_id").isNull(), "missing user")
    return table(spark, d, "events").select("event_id", error.alias("error")).filter("error IS NOT NULL")


# --- scalar functions --------------------------------------------------------------------------------


@query(f"SELECT c_custkey, '{NS}customer/' || c_custkey AS iri FROM customer")
def record_iri(spark, d):
    return table(spark, d, "customer").select("c_custkey", S.iri(NS + "customer/", text("c_custkey")).alias("iri"))


@query("SELECT c_custkey, o_orderkey, coalesce(o_orderpriority, c_name) AS label, coalesce(CAST(o_orderkey AS VARCHAR), '') AS value FROM customer LEFT JOIN orders ON o_custkey = c_custkey")
def label_coalesce(spark, d):
    joined = table(spark, d, "customer").join(table(spark, d, "orders"), c("o_custkey") == c("c_custkey"), "left")
    return joined.select("c_custkey", "o_orderkey", F.coalesce("o_orderpriority", "c_name").alias("label"), F.coalesce(text("o_orderkey"), F.lit("")).alias("value"))


@query("SELECT p_partkey, p_partkey || ': ' || p_name AS label FROM part")
def composed_label(spark, d):
    return table(spark, d, "part").select("p_partkey", S.composed_label(text("p_partkey"), "p_name").alias("label"))


@query(f"SELECT p_partkey, {_local_sql('p_name')} AS local, {_local_sql('p_type')} AS kind FROM part")
def uri_local(spark, d):
    return table(spark, d, "part").select("p_partkey", S.uri_local("p_name").alias("local"), S.uri_local("p_type").alias("kind"))


_PCT = "array_to_string(list_transform(string_split(text, ''), lambda x: CASE WHEN regexp_full_match(x, '[!-~]') AND NOT contains('\"#%<>[]{}|^`\\', x) THEN x WHEN x = '' THEN '' ELSE regexp_replace(hex(encode(x)), '(..)', '%\\1', 'g') END), '')"


@query(f"SELECT item_id, {_PCT} AS encoded FROM benchmark")
def pct_encode(spark, d):
    return table(spark, d, "benchmark").select("item_id", S.pct_encode("text").alias("encoded"))


@query(f"SELECT p_partkey, '{NS}part/' || p_partkey || '#' || replace(p_name, ' ', '%20') AS iri FROM part")
def property_iri(spark, d):
    return table(spark, d, "part").select("p_partkey", S.property_iri(NS + "part/", text("p_partkey"), "p_name").alias("iri"))


_ESCAPED = "replace(replace(replace(replace(replace(text, '\\', '\\\\'), '\"', '\\\"'), chr(10), '\\n'), chr(13), '\\r'), chr(9), '\\t')"


@query(f"SELECT doc_id, md5({_ESCAPED}) AS escaped, length({_ESCAPED}) AS n FROM documents")
def literal_escape(spark, d):
    return table(spark, d, "documents").select("doc_id", F.md5(S.escape("text").cast("binary")).alias("escaped"), F.length(S.escape("text")).cast("long").alias("n"))


@query("SELECT doc_id, md5(text) AS restored FROM documents")
def literal_unescape(spark, d):
    return table(spark, d, "documents").select("doc_id", F.md5(S.unescape(S.escape("text")).cast("binary")).alias("restored"))


@query(f"SELECT p_partkey, {_DEC.format(x='p_retailprice')} AS price, CAST(p_size AS VARCHAR) AS size FROM part")
def decimal_format(spark, d):
    return table(spark, d, "part").select("p_partkey", S.decimal_text("p_retailprice").alias("price"), S.decimal_text(S.parse_decimal(text("p_size"))).alias("size"))


@query("SELECT o_orderkey, '\"' || strftime(o_orderdate, '%Y-%m-%d') || '\"^^<http://www.w3.org/2001/XMLSchema#date>' AS literal FROM orders")
def typed_literal(spark, d):
    return table(spark, d, "orders").select("o_orderkey", S.typed_literal(F.date_format("o_orderdate", "yyyy-MM-dd"), vocab.XSD + "date").alias("literal"))


@query("SELECT p_partkey, '_:' || p_partkey || '_make' AS node FROM part")
def blank_node(spark, d):
    return table(spark, d, "part").select("p_partkey", S.bnode(text("p_partkey"), "make").alias("node"))


# --- row expansion -----------------------------------------------------------------------------------


@query(
    f"SELECT l_orderkey, l_linenumber, 0 AS place, '{NS}order/' || l_orderkey AS iri FROM lineitem UNION ALL SELECT l_orderkey, l_linenumber, 1, '{NS}part/' || l_partkey FROM lineitem UNION ALL SELECT l_orderkey, l_linenumber, 2, '{NS}supplier/' || l_suppkey FROM lineitem"
)
def seealso_unpivot(spark, d):
    links = F.array(*[S.iri(f"{NS}{n}/", text(k)) for n, k in (("order", "l_orderkey"), ("part", "l_partkey"), ("supplier", "l_suppkey"))])
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.posexplode(F.filter(links, lambda x: x.isNotNull())).alias("place", "iri"))


@query("SELECT event_id, k.name AS name, json_extract_string(props, '$.\"' || k.name || '\"') AS value FROM events, (SELECT unnest(json_keys(props)) AS name, event_id AS e FROM events) k WHERE k.e = event_id")
def eav_explode(spark, d):
    pairs = F.from_json("props", "map<string,string>")
    return table(spark, d, "events").select("event_id", F.explode(pairs).alias("name", "value"))


def _mapped(name: str):
    def f(spark, d):
        return triples_of(spark, d, name)

    f.__name__ = f"triples_{name}"
    return query(_TRIPLES[name])(f)


for _name in MAPPED:
    _mapped(_name)

_NODE, _SIZE = "'_:' || p_partkey || '_make'", "CASE WHEN p_size % 2 = 1 THEN '_:' || p_partkey || '_size' END"
_PART = f"'{NS}part/' || p_partkey"


def _node_rows(*rows: tuple[str, str, str, str, str | None]) -> str:
    parts = []
    for s, p, o, kind, datatype in rows:
        dt = f"'{datatype}'" if datatype else "CAST(NULL AS VARCHAR)"
        parts.append(f"SELECT 'part' AS source, {s} AS s, '{p}' AS p, {o} AS o, '{kind}' AS o_kind, {dt} AS o_datatype FROM part WHERE ({o}) IS NOT NULL AND ({s}) IS NOT NULL")
    return "\nUNION ALL ".join(parts)


@query(
    _node_rows(
        (_PART, vocab.RDF_TYPE, f"'{NS}ont/Part'", "iri", None),
        (_PART, vocab.DCT + "identifier", "CAST(p_partkey AS VARCHAR)", "literal", None),
        (_PART, NS + "ont/make", _NODE, "bnode", None),
        (_NODE, vocab.RDF_TYPE, f"'{NS}ont/' || {_local_sql('p_brand')}", "iri", None),
        (_NODE, NS + "ont/kind", f"'{NS}ont/' || {_local_sql('p_type')}", "iri", None),
        (_NODE, NS + "ont/size", _SIZE, "bnode", None),
        (_SIZE, vocab.RDF_TYPE, f"'{NS}ont/Size'", "iri", None),
        (_SIZE, NS + "ont/value", "CAST(p_size AS VARCHAR)", "literal", vocab.XSD + "decimal"),
    )
)
def nested_nodes(spark, d):
    return nested_mapping().triples(table(spark, d, "part"))


# --- renderers and sinks -----------------------------------------------------------------------------


@query(
    "SELECT '<' || s || '> <' || p || '> ' || CASE WHEN o_kind = 'literal' THEN '\"' || o || '\"' || coalesce('^^<' || o_datatype || '>', '') ELSE '<' || o || '>' END || ' .' AS line FROM (" + _TRIPLES["customer"] + ")"
)
def nt_lines_customer(spark, d):
    return nt_lines(triples_of(spark, d, "customer"))


@query(
    "SELECT c_custkey, 'customer:' || c_custkey || chr(10) || '  a ont:Customer ;' || chr(10) || '  dct:identifier \"' || c_custkey || '\" ;' || chr(10) || '  rdfs:label \"' || c_name || '\" ;' || chr(10) || '  ont:segment \"' || c_mktsegment || '\" ;' || chr(10) || "
    f"'  rdfs:seeAlso <{NS}nation/' || c_nationkey || '> .' || chr(10) || chr(10) AS block FROM customer"
)
def turtle_blocks(spark, d):
    return table(spark, d, "customer").select("c_custkey", customer_mapping().turtle().alias("block"))


@query(
    f"SELECT c_custkey, json_extract_string(j, '$.\"@id\"') AS id, json_extract_string(j, '$.\"@type\"') AS kind, json_extract_string(j, '$.\"rdfs:label\"') AS label, json_extract_string(j, '$.\"rdfs:seeAlso\"[0].\"@id\"') AS link FROM (SELECT c_custkey, json_object('@id', '{NS}customer/' || c_custkey, '@type', 'ont:Customer', 'rdfs:label', c_name, 'rdfs:seeAlso', [json_object('@id', '{NS}nation/' || c_nationkey)]) AS j FROM customer)"
)
def jsonld_records(spark, d):
    rows = table(spark, d, "customer").select("c_custkey", F.parse_json(customer_mapping().jsonld()).alias("j"))
    get = lambda path: F.variant_get("j", path, "string")
    return rows.select("c_custkey", get('$["@id"]').alias("id"), get('$["@type"]').alias("kind"), get('$["rdfs:label"]').alias("label"), get('$["rdfs:seeAlso"][0]["@id"]').alias("link"))


CHUNK = 1000


@query(f"SELECT chunk, 'chunk_' || lpad(CAST(chunk AS VARCHAR), 4, '0') AS name, count(*) AS n FROM (SELECT CAST(floor((row_number() OVER () - 1) / {CHUNK}) AS INTEGER) AS chunk FROM orders) GROUP BY chunk")
def chunk_assign(spark, d):
    rows = number_rows(table(spark, d, "orders").select("o_orderkey"), CHUNK)
    return rows.groupBy("chunk").agg(F.count("*").alias("n")).select("chunk", S.chunk_name("chunk").alias("name"), "n")


@query(f"SELECT CAST(ceil(count(*) / {CHUNK}.0) AS BIGINT) AS total_chunks, count(*) AS total_records, (SELECT count(*) FROM events WHERE event_type = 'error') AS records_skipped FROM events WHERE event_type <> 'error'")
def manifest(spark, d):
    bad = S.lookup("event_type", EVENT_CLASSES).isNull()
    counts = table(spark, d, "events").agg(F.count_if(~bad).alias("total_records"), F.count_if(bad).alias("records_skipped"))
    return counts.select(F.ceil(c("total_records") / CHUNK).alias("total_chunks"), "total_records", "records_skipped")


# --- graph queries -----------------------------------------------------------------------------------


@query(_ALL + f"SELECT o AS class, count(*) AS n FROM t WHERE p = '{vocab.RDF_TYPE}' GROUP BY o")
def type_counts(spark, d):
    return graph.type_counts(all_statements(spark, d, vocab.RDF_TYPE), distinct=True)


@query(_ALL + "SELECT count(*) AS n FROM t")
def triple_count(spark, d):
    return graph.triple_count(all_statements(spark, d), distinct=True)


@query(_ALL + "SELECT p, count(*) AS n FROM t GROUP BY p")
def predicate_dist(spark, d):
    return graph.predicate_distribution(all_statements(spark, d), distinct=True)


@query(_ALL + f"SELECT p, o FROM t WHERE s = '{NS}order/1'")
def spot_lookup(spark, d):
    """The key is compared in the scan, and tables of other namespaces are not read."""
    subject = NS + "order/1"
    found = [MAPPED[name]().of_subject(table(spark, d, name), subject) for name in MAPPED]
    return graph.spot_lookup(reduce(DataFrame.unionByName, [x for x in found if x is not None]), subject)


@query(_ALL + f"SELECT count(*) AS n FROM t WHERE p = '{vocab.RDF_TYPE}' AND o = '{NS}ont/LineItem'")
def class_count(spark, d):
    return graph.class_count(all_triples(spark, d, predicates=(vocab.RDF_TYPE,)), NS + "ont/LineItem")


@query(_ALL + f"SELECT count(DISTINCT s) AS n FROM t WHERE p = '{vocab.RDFS}seeAlso' AND starts_with(o, '{NS}supplier/')")
def crosslink_distinct(spark, d):
    return graph.crosslink_subjects(all_triples(spark, d, predicates=(vocab.RDFS + "seeAlso",)), NS + "supplier/")


@query(_ALL + f"SELECT * FROM t WHERE s LIKE '{NS}customer/%'")
def dedup_triples(spark, d):
    one = triples_of(spark, d, "customer")
    return graph.dedup(one.unionByName(one))


@query(f"SELECT '{NS}customer/' || c_custkey AS customer, '{NS}order/' || o_orderkey AS linked, a.name, a.value FROM customer JOIN (SELECT c_custkey AS k, 'name' AS name, c_name AS value FROM customer UNION ALL SELECT c_custkey, 'segment', c_mktsegment FROM customer) a ON a.k = c_custkey LEFT JOIN orders ON o_custkey = c_custkey")
def record_attributes(spark, d):
    parts = F.array(F.struct(F.lit("name").alias("name"), c("c_name").alias("value")), F.struct(F.lit("segment").alias("name"), c("c_mktsegment").alias("value")))
    parts = table(spark, d, "customer").select(S.iri(NS + "customer/", text("c_custkey")).alias("customer"), F.inline(parts))
    links = triples_of(spark, d, "orders", vocab.RDFS + "seeAlso").select(c("s").alias("linked"), c("o").alias("customer"))
    return parts.join(links, "customer", "left").select("customer", "linked", "name", "value")


@query(
    f"SELECT '{NS}order/' || o_orderkey AS record, '{NS}customer/' || c_custkey AS customer, '{NS}nation/' || c_nationkey AS nation, i.items FROM orders LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN (SELECT l_orderkey, count(*) AS items FROM lineitem GROUP BY 1) i ON l_orderkey = o_orderkey"
)
def object_relation(spark, d):
    link = lambda name: triples_of(spark, d, name, vocab.RDFS + "seeAlso")
    orders = link("orders").select(c("s").alias("record"), c("o").alias("customer"))
    customers = link("customer").select(c("s").alias("customer"), c("o").alias("nation"))
    items = link("lineitem").filter(c("o").startswith(NS + "order/")).groupBy(c("o").alias("record")).agg(F.count("*").alias("items"))
    return orders.join(customers, "customer", "left").join(items, "record", "left").select("record", "customer", "nation", "items")


@query(f"SELECT '{NS}item/' || {_KEY} AS s, min('{NS}order/' || l_orderkey) AS order_link, min('{NS}part/' || l_partkey) AS part_link, min('{NS}supplier/' || l_suppkey) AS supplier_link FROM lineitem GROUP BY 1")
def run_links(spark, d):
    spaces = {"order_link": NS + "order/", "part_link": NS + "part/", "supplier_link": NS + "supplier/"}
    return graph.record_links(table(spark, d, "lineitem"), lineitem_mapping().subject, F.lit(True), lineitem_links(), spaces)


@query(f"SELECT '{NS}order/' || o_orderkey AS s, '{NS}customer/' || o_custkey AS customer_link FROM orders WHERE o_orderstatus = 'F'")
def experiment_links(spark, d):
    return graph.links_by_class(triples_of(spark, d, "orders", vocab.RDF_TYPE, vocab.RDFS + "seeAlso"), NS + "ont/FilledOrder", {"customer_link": NS + "customer/"})


# --- shapes, validation, reconciliation ---------------------------------------------------------------


@query(_ALL + f", m AS (SELECT DISTINCT s FROM t WHERE p = '{vocab.RDF_TYPE}' AND o = '{NS}ont/LineItem') SELECT m.s, (SELECT count(*) FROM t WHERE t.s = m.s AND p = '{vocab.RDFS}seeAlso') AS n FROM m WHERE n < 1 OR n > 2")
def shape_cardinality(spark, d):
    return validate.cardinality(triples_of(spark, d, "lineitem", vocab.RDF_TYPE, vocab.RDFS + "seeAlso"), NS + "ont/LineItem", vocab.RDFS + "seeAlso", 1, 2)


@query(f"SELECT '{NS}order/' || o_orderkey AS s FROM orders WHERE o_orderstatus NOT IN ('F', 'O')")
def shape_class(spark, d):
    """Subjects that should be open or filled orders, and are not."""
    return validate.not_of_class(triples_of(spark, d, "orders", vocab.RDF_TYPE, vocab.DCT + "identifier"), [NS + "ont/FilledOrder", NS + "ont/OpenOrder"], NS + "order/")


@query(_MULTI + f"SELECT s, o FROM t WHERE p = '{vocab.DCT}issued' AND o_datatype IS DISTINCT FROM '{vocab.XSD}dateTime' AND s IN (SELECT s FROM t WHERE p = '{vocab.RDF_TYPE}' AND o = '{NS}ont/OpenOrder')")
def shape_datatype(spark, d):
    return validate.datatype(triples_of(spark, d, "orders"), NS + "ont/OpenOrder", vocab.DCT + "issued", vocab.XSD + "dateTime")


@query(_MULTI + f"SELECT s, o FROM t WHERE p = '{vocab.RDFS}seeAlso' AND EXISTS (SELECT 1 FROM t m WHERE m.s = t.s AND m.p = '{vocab.RDF_TYPE}' AND m.o = '{NS}ont/LineItem') AND NOT EXISTS (SELECT 1 FROM t m WHERE m.s = t.o AND m.p = '{vocab.RDF_TYPE}' AND m.o = '{NS}ont/Part')")
def shape_ref(spark, d):
    return validate.reference(all_triples(spark, d, "lineitem", "part", predicates=(vocab.RDF_TYPE, vocab.RDFS + "seeAlso")), NS + "ont/LineItem", vocab.RDFS + "seeAlso", NS + "ont/Part")


@query(_MULTI + f"SELECT s, o FROM t WHERE p = '{vocab.RDFS}label' AND o_kind <> 'iri' AND s IN (SELECT s FROM t WHERE p = '{vocab.RDF_TYPE}' AND o = '{NS}ont/Part')")
def shape_nodekind(spark, d):
    return validate.node_kind(triples_of(spark, d, "part"), NS + "ont/Part", vocab.RDFS + "label", "iri")


@query("SELECT CAST(p_partkey AS VARCHAR) AS key, 'kind' AS field, p_type AS expected, CASE WHEN p_partkey % 10 = 0 THEN 'other' ELSE p_type END AS found FROM part WHERE p_partkey % 10 = 0")
def field_fidelity(spark, d):
    """Terms read back from triples, some of them changed on the way."""
    said = nested_mapping().triples(table(spark, d, "part"))
    back = reconcile.pivot(said.filter(c("s").startswith("_:")), {"kind": NS + "ont/kind"}).filter("kind IS NOT NULL")
    key = F.regexp_extract("s", "^_:([0-9]+)_make$", 1)
    written = back.select(key.alias("key"), F.when(key.cast("long") % 10 == 0, "other").otherwise(F.replace("kind", F.lit(NS + "ont/"), F.lit(""))).alias("kind"))
    records = table(spark, d, "part").select(text("p_partkey").alias("key"), c("p_type").alias("kind"))
    return reconcile.field_fidelity(records, written, "key", ["kind"])


# --- scans -------------------------------------------------------------------------------------------


@query("SELECT CAST(c_custkey AS VARCHAR) AS accession, c_name AS title, 2 AS attributes, c_mktsegment AS first_value FROM customer")
def xml_extract(spark, d):
    """Records written as XML text, and scanned."""
    xml = F.format_string('<BioSample accession="%s"><Description><Title>%s</Title></Description><Attributes><Attribute attribute_name="segment">%s</Attribute><Attribute attribute_name="none"/></Attributes>', text("c_custkey"), c("c_name"), c("c_mktsegment"))
    found = scan.biosample_rows(table(spark, d, "customer").select(F.lit("t").alias("file"), xml.alias("value"))).records
    return found.select("accession", "title", F.size("attributes").alias("attributes"), F.get("attributes", F.lit(0))["value"].alias("first_value"))


@query("SELECT CAST(o_orderkey AS VARCHAR) AS accession, 'Run' AS class, CAST(o_custkey AS VARCHAR) AS sample FROM orders WHERE o_orderstatus = 'F'")
def tsv_parse(spark, d):
    """Rows written as TSV lines, and scanned."""
    live = F.when(c("o_orderstatus") == "F", "live").otherwise("gone")
    fields = [F.lit("-")] * 20
    fields[0], fields[2], fields[6], fields[11] = text("o_orderkey"), live, F.lit("RUN"), text("o_custkey")
    lines = table(spark, d, "orders").select(F.lit("t").alias("file"), F.concat_ws("\t", *fields).alias("value"))
    return scan.sra_rows(lines).records.select("accession", S.lookup("sra_type", vocab.SRA_CLASSES).alias("class"), "sample")


@query("SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title FROM pages")
def markup_title(spark, d):
    return table(spark, d, "pages").select("page_id", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"))


from . import written  # noqa: E402, F401  registers the queries that go through files
