"""Scalar functions of the mapping, as Column expressions: nothing here leaves the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: ASCII characters, beside controls, that a name in an IRI fragment must not contain.
ENCODED = "\"#%<>[]{}|^`\\ "


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nonempty(c: Column | str) -> Column:
    """Null for an empty string and for a lone dash."""
    return F.when(~col(c).isin("", "-"), col(c))


def lookup(c: Column | str, names: dict[str, str]) -> Column:
    """The value that a fixed table has for c, null for others: exact and case-sensitive."""
    out = None
    for key, value in names.items():
        out = F.when(col(c) == key, value) if out is None else out.when(col(c) == key, value)
    return out


def iri(namespace: str, c: Column | str) -> Column:
    return F.concat(F.lit(namespace), col(c))


def pct_encode(c: Column | str) -> Column:
    """UTF-8 percent-encoding of controls, ENCODED and everything that is not ASCII."""
    plain = lambda x: x.rlike(r"^[\x21-\x7e]$") & ~F.contains(F.lit(ENCODED), x)
    one = lambda x: F.when(plain(x), x).otherwise(F.regexp_replace(F.hex(F.encode(x, "UTF-8")), "(..)", "%$1"))
    chars = F.regexp_extract_all(col(c), F.lit("(?s)(.)"), F.lit(1))
    encoded = F.array_join(F.transform(chars, one), "")
    # names are mostly plain; those skip the walk over their characters
    return F.when(col(c).rlike(r"^[A-Za-z0-9_.:/()'?&+~!$*,;=@-]*$"), col(c)).otherwise(encoded)


def property_iri(namespace: str, accession: Column | str, name: Column | str) -> Column:
    return F.concat(F.lit(namespace), col(accession), F.lit("#"), pct_encode(name))


def uri_local(c: Column | str) -> Column:
    """Trimmed of Unicode white space, spaces inside as underscores."""
    return F.replace(F.regexp_replace(col(c), r"(?U)^\s+|\s+$", ""), F.lit(" "), F.lit("_"))


def _replaced(c: Column, pairs: list[tuple[str, str]]) -> Column:
    for a, b in pairs:
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def escape(c: Column | str) -> Column:
    """A literal's text between quotes, in Turtle and N-Triples."""
    return _replaced(col(c), [("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")])


def unescape(c: Column | str) -> Column:
    """The inverse of :func:`escape`: between escaped backslashes, every other escape stands for itself."""
    parts = F.split(col(c), r"\\\\", -1)
    back = lambda x: _replaced(x, [('\\"', '"'), ("\\n", "\n"), ("\\r", "\r"), ("\\t", "\t")])
    return F.when(F.contains(col(c), F.lit("\\")), F.array_join(F.transform(parts, back), "\\")).otherwise(col(c))


def decimal_text(c: Column | str) -> Column:
    """A double without exponent and without a fraction of zeros."""
    return F.replace(F.call_function("format_number", col(c), F.lit("0." + "#" * 340)), F.lit(","), F.lit(""))


def parse_decimal(c: Column | str) -> Column:
    """A double, or null if the text is not a plain number: no blanks, suffixes, infinity or NaN."""
    return F.when(col(c).rlike(r"^[+-]?(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)(?:[eE][+-]?[0-9]+)?$"), col(c).try_cast("double"))


def typed_literal(c: Column | str, datatype: str) -> Column:
    return F.concat(F.lit('"'), escape(c), F.lit(f'"^^<{datatype}>'))


def bnode(accession: Column | str, label: str) -> Column:
    """A blank node's label, the same on every attempt: records have at most one node of a kind.

    Other characters of an accession than letters and digits are the hex digits of their bytes, each after an
    underscore, so that different accessions have different labels.
    """
    hexed = lambda x: F.when(x.rlike("^[A-Za-z0-9]$"), x).otherwise(F.regexp_replace(F.hex(F.encode(x, "UTF-8")), "(..)", "_$1"))
    plain = F.array_join(F.transform(F.regexp_extract_all(col(accession), F.lit("(?s)(.)"), F.lit(1)), hexed), "")
    return F.concat(F.lit("_:"), F.when(col(accession).rlike("^[A-Za-z0-9]*$"), col(accession)).otherwise(plain), F.lit(f"_{label}"))


def chunk_name(c: Column | str) -> Column:
    return F.format_string("chunk_%04d", col(c))


def composed_label(accession: Column | str, title: Column | str) -> Column:
    return F.concat(col(accession), F.lit(": "), col(title))


def literal_text(c: Column | str) -> Column:
    """The text of the first quoted literal of a line, unescaped; null without one."""
    found = F.nullif(F.regexp_extract(col(c), r'("(?:[^"\\]|\\.)*")', 1), F.lit(""))
    return unescape(F.substring(found, F.lit(2), F.length(found) - 2))


def json_text(c: Column | str) -> Column:
    """A JSON string with its quotes; null stays null. Texts without characters to escape are only put in quotes."""
    listed = F.to_json(F.array(col(c)))
    plain = col(c).rlike(r"^[^\"\\\x00-\x1f\x7f-\u009f\u2028\u2029]*$")
    return F.when(plain, F.concat(F.lit('"'), col(c), F.lit('"'))).when(col(c).isNotNull(), F.substring(listed, F.lit(2), F.length(listed) - 2))
