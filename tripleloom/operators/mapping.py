"""Declarative mapping of records to triples and to the three syntaxes.

A :class:`Mapping` lists, in order, what a record says. The triple table and all renderers are
derived from that one list, as Column expressions over the record.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import vocab
from ..functions import scalars as S

TRIPLE = "struct<s:string,p:string,o:string,o_kind:string,o_datatype:string>"
_LOCAL = r"^[A-Za-z0-9_](?:[A-Za-z0-9_.-]*[A-Za-z0-9_-])?$"


@dataclass(frozen=True)
class Text:
    """A literal; ``datatype`` is a prefixed name such as xsd:dateTime. Null values say nothing."""

    predicate: str
    value: Column
    datatype: str | None = None


@dataclass(frozen=True)
class Term:
    """A controlled term: a local name within a prefix."""

    predicate: str
    prefix: str
    local: Column


@dataclass(frozen=True)
class Links:
    """IRIs of which some may be null, one statement each."""

    predicate: str
    iris: tuple[Column, ...]


@dataclass(frozen=True)
class Node:
    """A blank node that exists if any of ``given`` is not null. ``type`` may be null."""

    predicate: str
    label: str
    type: tuple[str, Column] | None
    statements: tuple
    given: tuple[Column, ...]


@dataclass(frozen=True)
class Parts:
    """An array of structs ``(iri, name, value)``: a statement each, and a named resource each."""

    predicate: str
    items: Column
    type: str
    name: str
    value: str


@dataclass(frozen=True)
class Mapping:
    source: str
    prefixes: dict[str, str]
    subject_prefix: str
    key: Column
    type: tuple[str, Column]
    statements: tuple
    context: dict[str, str] = field(default_factory=dict)
    #: A prefix that is written as a bare colon in Turtle and not at all in JSON-LD.
    default: str | None = None
    #: The rows of a key given as text, by a filter that reaches the scan; by default the key's expression is compared.
    having: Callable[[str], Column] | None = None

    def full(self, name: str) -> str:
        prefix, _, local = name.partition(":")
        return self.prefixes[prefix] + local

    @property
    def subject(self) -> Column:
        return S.iri(self.prefixes[self.subject_prefix], self.key)

    # --- triples -------------------------------------------------------------------------------

    def _rows(self, s: Column, statements: tuple, predicates: set[str] | None, on: Column | None = None) -> list[Column]:
        """Structs of the single statements, null where nothing is said; plain expressions, no lambdas."""
        out = []

        def add(p: str, o: Column, kind: str, datatype: str | None = None, subject: Column = s, given: Column | None = on) -> None:
            if predicates is None or p in predicates:
                said = o.isNotNull() if given is None else given & o.isNotNull()
                out.append(F.when(said, self._row(subject, p, o, kind, datatype)))

        for x in statements:
            if isinstance(x, Text):
                add(self.full(x.predicate), x.value, "literal", self.full(x.datatype) if x.datatype else None)
            elif isinstance(x, Term):
                add(self.full(x.predicate), S.iri(self.prefixes[x.prefix], x.local), "iri")
            elif isinstance(x, Links):
                for i in x.iris:
                    add(self.full(x.predicate), i, "iri")
            elif isinstance(x, Node):
                there = F.coalesce(*x.given).isNotNull() if on is None else on & F.coalesce(*x.given).isNotNull()
                node = S.bnode(self.key, x.label)
                add(self.full(x.predicate), node, "bnode", given=there)
                if x.type:
                    add(vocab.RDF_TYPE, S.iri(self.prefixes[x.type[0]], x.type[1]), "iri", subject=node, given=there)
                out += self._rows(node, x.statements, predicates, there)
        return out

    def _part_rows(self, s: Column, x: Parts, predicates: set[str] | None) -> Column:
        """The array of a :class:`Parts`: four statements an item."""

        def rows(a: Column) -> Column:
            every = [(s, self.full(x.predicate), a.iri, "iri"), (a.iri, vocab.RDF_TYPE, F.lit(self.full(x.type)), "iri"), (a.iri, self.full(x.name), a["name"], "literal"), (a.iri, self.full(x.value), a["value"], "literal")]
            kept = [self._row(*r) for r in every if predicates is None or r[1] in predicates]
            return F.array(*kept) if kept else F.array().cast(f"array<{TRIPLE}>")

        return F.coalesce(F.flatten(F.transform(x.items, rows)), F.array().cast(f"array<{TRIPLE}>"))

    @staticmethod
    def _row(s: Column, p: str, o: Column, kind: str, datatype: str | None = None) -> Column:
        return F.struct(s.alias("s"), F.lit(p).alias("p"), o.alias("o"), F.lit(kind).alias("o_kind"), F.lit(datatype).cast("string").alias("o_datatype")).cast(TRIPLE)

    def _said_rows(self, predicates: set[str] | None = None) -> Column:
        """All statements of a record as an array, with nulls where nothing is said."""
        head = [F.when(self.type[1].isNotNull(), self._row(self.subject, vocab.RDF_TYPE, S.iri(self.prefixes[self.type[0]], self.type[1]), "iri"))]
        rows = (head if predicates is None or vocab.RDF_TYPE in predicates else []) + self._rows(self.subject, self.statements, predicates)
        single = F.array(*rows) if rows else F.array().cast(f"array<{TRIPLE}>")
        parts = [self._part_rows(self.subject, x, predicates) for x in self.statements if isinstance(x, Parts)]
        return F.concat(single, *parts) if parts else single

    def triple_array(self) -> Column:
        return F.filter(self._said_rows(), lambda t: t.isNotNull())

    def triples(self, records: DataFrame, predicates: set[str] | None = None) -> DataFrame:
        """(source, s, p, o, o_kind, o_datatype): what the records say, in their order. No shuffle.

        With ``predicates`` only their statements are made, and only the columns they need are read.
        """
        return records.select(F.lit(self.source).alias("source"), F.inline(self._said_rows(predicates))).filter(F.col("s").isNotNull())

    def of_subject(self, records: DataFrame, subject: str) -> DataFrame | None:
        """The triples of one subject, None if its IRI is not in this mapping's namespace; only its records are mapped."""
        namespace = self.prefixes[self.subject_prefix]
        if not subject.startswith(namespace):
            return None
        key = subject.removeprefix(namespace)
        rows = records.filter(self.having(key) if self.having else self.key == key)
        return self.triples(rows).filter(F.col("s") == subject)

    def distinct_triples(self, records: DataFrame, predicates: set[str] | None = None) -> DataFrame:
        """The triples, each once, as (source, s, p, o, o_kind, o_datatype).

        A subject belongs to one key, so equal triples only come from one record, or from records of one key.
        The keys alone are shuffled to find those that occur more than once; such records are the only
        ones of which the triples are compared with each other.
        """
        single = lambda rows: rows.select(F.lit(self.source).alias("source"), F.inline(F.array_distinct(self._said_rows(predicates)))).filter(F.col("s").isNotNull())
        often = records.select(self.key.alias("__key")).groupBy("__key").count().filter("count > 1").select("__key")
        if often.isEmpty():
            return single(records)
        keyed = records.withColumn("__key", self.key)
        again = self.triples(keyed.join(often, "__key", "left_semi"), predicates).distinct()
        return single(keyed.join(often, "__key", "left_anti")).unionByName(again)

    # --- N-Triples -------------------------------------------------------------------------------

    def ntriples(self) -> Column:
        """The lines of a record, each with its line end.

        Single statements are joined as columns, which stays in generated code; only the arrays of
        :class:`Parts` are walked by a lambda.
        """
        head = F.when(self.type[1].isNotNull(), self._line(self.subject, vocab.RDF_TYPE, self._iri(S.iri(self.prefixes[self.type[0]], self.type[1]))))
        parts = [F.array_join(F.transform(x.items, self._part_lines(x)), "\n") for x in self.statements if isinstance(x, Parts)]
        parts = [F.when(F.size(x.items) > 0, p) for x, p in zip([x for x in self.statements if isinstance(x, Parts)], parts, strict=True)]
        return F.concat(F.concat_ws("\n", head, *self._lines(self.subject, self.statements), *parts), F.lit("\n"))

    @staticmethod
    def _iri(c: Column) -> Column:
        return F.concat(F.lit("<"), c, F.lit(">"))

    def _line(self, s: Column, p: str, o: Column, given: Column | None = None, node: bool = False) -> Column:
        line = F.concat(s if node else self._iri(s), F.lit(f" <{p}> "), o, F.lit(" ."))
        return line if given is None else F.when(given, line)

    def _lines(self, s: Column, statements: tuple, given: Column | None = None, node: bool = False) -> list[Column]:
        """Lines of the single statements, null where nothing is said."""
        out = []
        for x in statements:
            if isinstance(x, Text):
                end = f"^^<{self.full(x.datatype)}>" if x.datatype else ""
                out.append(self._line(s, self.full(x.predicate), F.concat(F.lit('"'), S.escape(x.value), F.lit('"' + end)), given, node))
            elif isinstance(x, Term):
                out.append(self._line(s, self.full(x.predicate), self._iri(S.iri(self.prefixes[x.prefix], x.local)), given, node))
            elif isinstance(x, Links):
                out += [self._line(s, self.full(x.predicate), self._iri(i), given, node) for i in x.iris]
            elif isinstance(x, Node):
                there = F.coalesce(*x.given).isNotNull() if given is None else given & F.coalesce(*x.given).isNotNull()
                label = S.bnode(self.key, x.label)
                out.append(self._line(s, self.full(x.predicate), label, there, node))
                if x.type:
                    out.append(self._line(label, vocab.RDF_TYPE, self._iri(S.iri(self.prefixes[x.type[0]], x.type[1])), there, True))
                out += self._lines(label, x.statements, there, True)
        return out

    def _part_lines(self, x: Parts):
        quoted = lambda c: F.concat(F.lit('"'), S.escape(c), F.lit('"'))

        def lines(a: Column) -> Column:
            return F.concat_ws(
                "\n",
                self._line(self.subject, self.full(x.predicate), self._iri(a.iri)),
                self._line(a.iri, vocab.RDF_TYPE, F.lit(f"<{self.full(x.type)}>")),
                self._line(a.iri, self.full(x.name), quoted(a["name"])),
                self._line(a.iri, self.full(x.value), quoted(a["value"])),
            )

        return lines

    # --- Turtle ----------------------------------------------------------------------------------

    def turtle_header(self) -> str:
        return "".join(f"@prefix {'' if p == self.default else p}: <{ns}> .\n" for p, ns in self.prefixes.items() if not p.startswith("_")) + "\n"

    def _name(self, name: str) -> str:
        prefix, _, local = name.partition(":")
        return f"{'' if prefix == self.default else prefix}:{local}"

    def _local(self, prefix: str, local: Column) -> Column:
        short = F.concat(F.lit(("" if prefix == self.default else prefix) + ":"), local)
        return F.when(local.rlike(_LOCAL), short).otherwise(F.concat(F.lit("<" + self.prefixes[prefix]), local, F.lit(">")))

    def _said(self, statements: tuple) -> list[Column]:
        """Texts "predicate object", null where nothing is said."""
        out = []
        for x in statements:
            lead = F.lit(self._name(x.predicate) + " ")
            if isinstance(x, Text):
                out.append(F.concat(lead, F.lit('"'), S.escape(x.value), F.lit('"' + (f"^^{x.datatype}" if x.datatype else ""))))
            elif isinstance(x, Term):
                out.append(F.when(x.local.isNotNull(), F.concat(lead, self._local(x.prefix, x.local))))
            elif isinstance(x, Links):
                out += [F.concat(lead, self._iri(i)) for i in x.iris]
            elif isinstance(x, Node):
                inner = [F.when(x.type[1].isNotNull(), F.concat(F.lit("a "), self._local(*x.type)))] if x.type else []
                body = F.concat_ws(" ;\n    ", *inner, *self._said(x.statements))
                out.append(F.when(F.coalesce(*x.given).isNotNull(), F.concat(lead, F.lit("[\n    "), body, F.lit("\n  ]"))))
            else:
                names = F.array_join(F.transform(x.items, lambda a: F.concat(F.lit("    <"), a.iri, F.lit(">"))), " ,\n")
                out.append(F.when(F.size(x.items) > 0, F.concat(F.lit(self._name(x.predicate) + "\n"), names)))
        return out

    def turtle(self) -> Column:
        """The block of a record, and one for each of its parts, each with a blank line after it."""
        lines = F.concat_ws(" ;\n  ", F.concat(F.lit("a "), self._local(*self.type)), *self._said(self.statements))
        block = F.concat(self._local(self.subject_prefix, self.key), F.lit("\n  "), lines, F.lit(" .\n\n"))
        for x in self.statements:
            if isinstance(x, Parts):
                block = F.concat(block, F.array_join(F.transform(x.items, self._part_block(x)), ""))
        return block

    def _part_block(self, x: Parts):
        def block(a: Column) -> Column:
            name = F.concat(F.lit(f'> a {self._name(x.type)} ;\n  {self._name(x.name)} "'), S.escape(a["name"]))
            return F.concat(F.lit("<"), a.iri, name, F.lit(f'" ;\n  {self._name(x.value)} "'), S.escape(a["value"]), F.lit('" .\n\n'))

        return block

    # --- JSON-LD ---------------------------------------------------------------------------------

    def _key(self, name: str) -> str:
        prefix, _, local = name.partition(":")
        return local if prefix == self.default else name

    def _members(self, statements: tuple, depth: int) -> list[Column]:
        out = []
        for x in statements:
            key = self._key(x.predicate)
            if isinstance(x, Text) and x.datatype:
                value = F.when(x.value.isNotNull(), json_object([json_member("@value", S.json_text(x.value)), json_member("@type", S.json_text(F.lit(x.datatype)))], depth + 1))
            elif isinstance(x, Text):
                value = S.json_text(x.value)
            elif isinstance(x, Term):
                value = F.when(x.local.isNotNull(), json_object([json_member("@id", S.json_text(F.concat(F.lit(x.prefix + ":"), x.local)))], depth + 1))
            elif isinstance(x, Links):
                each = [F.when(i.isNotNull(), json_object([json_member("@id", S.json_text(i))], depth + 2)) for i in x.iris]
                value = F.when(F.coalesce(*x.iris).isNotNull(), json_items(F.concat_ws(json_comma(depth + 1), *each), depth + 1))
            elif isinstance(x, Node):
                kind = [json_member("@type", S.json_text(F.concat(F.lit(x.type[0] + ":"), x.type[1])))] if x.type else []
                value = F.when(F.coalesce(*x.given).isNotNull(), json_object([*kind, *self._members(x.statements, depth + 1)], depth + 1))
            else:
                value = json_array(F.transform(x.items, self._part_object(x, depth + 2)), depth + 1)
            out.append(json_member(key, value))
        return out

    def _part_object(self, x: Parts, depth: int):
        def shown(a: Column) -> Column:
            parts = [("@type", F.lit(self._key(x.type))), ("@id", a.iri), (self._key(x.name), a["name"]), (self._key(x.value), a["value"])]
            return json_object([json_member(k, S.json_text(v)) for k, v in parts], depth)

        return shown

    def jsonld(self) -> Column:
        """The object of a record, two blanks a level; absent values and empty arrays are left out."""
        context = json_object([json_member(k, S.json_text(F.lit(v))) for k, v in self.context.items()], 1)
        head = [json_member("@context", context), json_member("@type", S.json_text(F.concat(F.lit(self.type[0] + ":"), self.type[1]))), json_member("@id", S.json_text(self.subject))]
        return json_object([*head, *self._members(self.statements, 0)], 0)


def json_member(key: str, value: Column) -> Column:
    return F.concat(F.lit(f'"{key}": '), value)


def json_comma(depth: int) -> str:
    return ",\n" + "  " * (depth + 1)


def json_object(members: list[Column], depth: int) -> Column:
    """An object of the members that are not null."""
    pad = "  " * depth
    return F.concat(F.lit(f"{{\n{pad}  "), F.concat_ws(json_comma(depth), *members), F.lit(f"\n{pad}}}"))


def json_items(body: Column, depth: int) -> Column:
    pad = "  " * depth
    return F.concat(F.lit(f"[\n{pad}  "), body, F.lit(f"\n{pad}]"))


def json_array(items: Column, depth: int) -> Column:
    return F.when(F.size(items) > 0, json_items(F.array_join(items, json_comma(depth)), depth))


def nt_line(t: Column) -> Column:
    """One triple as a line without its end."""
    term = lambda c: F.when(c.startswith("_:"), c).otherwise(F.concat(F.lit("<"), c, F.lit(">")))
    literal = F.concat(F.lit('"'), S.escape(t.o), F.lit('"'), F.coalesce(F.concat(F.lit("^^<"), t.o_datatype, F.lit(">")), F.lit("")))
    o = F.when(t.o_kind == "literal", literal).when(t.o_kind == "bnode", t.o).otherwise(F.concat(F.lit("<"), t.o, F.lit(">")))
    return F.concat(term(t.s), F.lit(" <"), t.p, F.lit("> "), o, F.lit(" ."))


def nt_lines(triples: DataFrame) -> DataFrame:
    """(line) for every row of a triple table."""
    return triples.select(nt_line(F.struct("s", "p", "o", "o_kind", "o_datatype")).alias("line"))
