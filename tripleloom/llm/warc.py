"""Content-addressed WARC archive: payloads once by digest, header blocks apart, records by joins.

An archive is a folder with two tables. ``payloads`` has a row per different payload, under its
SHA-256 and length; ``records`` has the exact header block of every record and the key of its
payload. A record's bytes are its header block, its payload unless it is a revisit, and the two
line ends that close it. Reading verifies every payload against its key and its header's digest.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import prepare

EOL = "\r\n"
END = EOL + EOL
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"


def base32_sha1(data: Column) -> Column:
    """The SHA-1 of bytes in upper-case base32: each five hex digits make four base32 digits."""
    hexed = F.sha1(data)
    parts = [F.lpad(F.conv(F.substring(hexed, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.upper(F.concat(*parts)), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def record_id(page: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("none")), F.lit(">"))


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit(EOL))


def _header(revisit: Column) -> Column:
    """The header block; an address that is null has no line, and line ends in it are escaped."""
    address = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    lines = [
        F.lit("WARC/1.1" + EOL),
        _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", record_id(F.col("page_id"))),
        _line("WARC-Date", F.lit(DATE)),
        F.coalesce(_line("WARC-Target-URI", address), F.lit("")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(revisit, F.concat(_line("WARC-Refers-To", record_id(F.col("first"))), _line("WARC-Profile", F.lit(REVISIT_PROFILE)))).otherwise(F.lit("")),
        _line("Content-Type", F.lit("text/html")),
        _line("Content-Length", F.when(revisit, 0).otherwise(F.col("payload_bytes")).cast("string")),
        F.lit(EOL),
    ]
    return F.concat(*lines)


def write_archive(pages: DataFrame, path: str, least_bytes: int = 0) -> None:
    """Write the archive of ``pages(page_id, url, html)``; a null html is an empty payload.

    Of records with equal payloads of at least ``least_bytes`` bytes the one with the largest
    page_id is the response, and all others are revisits of it; rows with that same id are
    responses too. Null ids are smaller than all others. Payload copies are combined map-side, so
    one payload may have any number of records.
    """
    rows = pages.select("page_id", "url", F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload"))
    key = [F.sha2("payload", 256).alias("sha256"), F.length("payload").cast("long").alias("payload_bytes")]
    marks = rows.select("page_id", "url", *key, base32_sha1(F.col("payload")).alias("digest"))
    firsts = marks.filter(F.col("payload_bytes") >= least_bytes).groupBy("sha256", "payload_bytes").agg(F.max("page_id").alias("first"), F.lit(True).alias("shared"))
    joined = marks.join(firsts, ["sha256", "payload_bytes"], "left")
    revisit = F.coalesce(F.col("shared"), F.lit(False)) & ~F.col("page_id").eqNullSafe(F.col("first"))
    joined.select(_header(revisit).alias("header"), "sha256", "payload_bytes").write.parquet(f"{path}/records")
    rows.select(*key, "payload").groupBy("sha256", "payload_bytes").agg(F.first("payload").alias("payload")).write.option("compression", "zstd").parquet(f"{path}/payloads")


def _field(name: str) -> Column:
    return F.nullif(F.regexp_extract("header", rf"(?i)\r\n{name}: *([^\r]*)\r\n", 1), F.lit(""))


def _page(urn: Column) -> Column:
    return F.regexp_extract(urn, "^<urn:page:(-?[0-9]+)>$", 1).try_cast("long")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Records of an archive: the parsed header, its exact block, the full payload and the record's bytes.

    A payload that differs from its key or from the digest in a header ends the job with an error,
    as does a record without payload.
    """
    # what is verified travels with a payload's key; the bytes are joined only where they are asked for
    found = spark.read.parquet(f"{path}/payloads")
    sound = (F.sha2("payload", 256) == F.col("sha256")) & (F.length("payload") == F.col("payload_bytes"))
    found = found.select("sha256", "payload_bytes", "payload", base32_sha1(F.col("payload")).alias("found"), sound.alias("sound"))
    records = spark.read.parquet(f"{path}/records").join(found, ["sha256", "payload_bytes"], "left")
    digest = F.regexp_replace(_field("WARC-Payload-Digest"), "^sha1:", "")
    right = F.coalesce(F.col("sound") & (F.col("found") == digest), F.lit(False))
    checked = F.when(right, F.col("found")).otherwise(F.raise_error(F.concat(F.lit("bad payload for "), _field("WARC-Record-ID"))))
    body = F.when(_field("WARC-Type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    return records.select(
        _page(_field("WARC-Record-ID")).alias("page_id"),
        _field("WARC-Target-URI").alias("url"),
        "payload_bytes",
        checked.alias("payload_digest"),
        _field("WARC-Type").alias("record_type"),
        _page(_field("WARC-Refers-To")).alias("refers_to"),
        "header",
        "payload",
        F.concat(F.col("header").cast("binary"), body, F.lit(END.encode())).alias("record"),
    )


def export_files(archive: DataFrame, path: str) -> None:
    """Write the records of :func:`read_archive` as plain WARC files, one per partition."""
    body = F.when(F.col("record_type") == "revisit", "").otherwise(F.col("payload").cast("string"))
    archive.select(F.concat("header", body)).write.option("lineSep", END).text(path)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """(file, header, payload) of every record in plain WARC files, by their Content-Length."""
    prepare(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                view = content.as_buffer().to_pybytes()
                at, heads, bodies = 0, [], []
                while at < len(view):
                    stop = view.index(END.encode(), at) + len(END)
                    size = int(re.search(rb"(?i)\r\nContent-Length: *(\d+)", view[at:stop])[1])
                    heads.append(view[at:stop].decode()), bodies.append(view[stop : stop + size])
                    at = stop + size + len(END)
                yield pa.RecordBatch.from_arrays([pa.array([file] * len(heads), pa.string()), pa.array(heads, pa.string()), pa.array(bodies, pa.binary())], ["file", "header", "payload"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, "file string, header string, payload binary")
