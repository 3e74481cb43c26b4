"""Chunked sink: one pass renders the three syntaxes, and every task writes its own stretch of the chunks.

Chunk numbers are contiguous over the whole run without sorting or shuffling it: the rendered rows are
staged, each input partition is counted, and the counts' running sum gives every row its index. A
chunk that lies in one partition is a file at once; the pieces of others are put together by tasks of their own.
"""

from __future__ import annotations

import contextlib
import json
import sys
import threading
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import UTC, datetime
from itertools import accumulate

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from ..sources import Parsed
from ..sources.archive import files, fingerprint, open_path
from .mapping import Mapping

FORMATS = ("ttl", "jsonld", "nt")
CHUNK_SIZE = 100_000
#: Seconds between looks at the chunks that are done.
PROGRESS_SECONDS = 2.0
HUGE_METHOD = "spark.sql.codegen.hugeMethodLimit"


def _numbered(df: DataFrame, chunk_size: int) -> tuple[DataFrame, int]:
    """df with ``chunk`` and ``place``, and its number of rows."""
    marked = df.withColumn("__id", F.monotonically_increasing_id())
    part = F.shiftright("__id", 33)
    counts = sorted((x.part, x["count"]) for x in marked.groupBy(part.alias("part")).count().collect())
    starts = [0, *accumulate(n for _, n in counts)]
    table = df.sparkSession.createDataFrame([(p, s) for (p, _), s in zip(counts, starts, strict=False)], "__part long, __start long")
    index = F.col("__start") + F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))
    out = marked.withColumn("__part", part.cast("long")).join(F.broadcast(table), "__part")  # a row a partition
    return out.withColumn("place", index).withColumn("chunk", F.floor(index / chunk_size).cast("int")).drop("__id", "__part", "__start"), starts[-1]


def number_rows(df: DataFrame, chunk_size: int) -> DataFrame:
    """df with ``chunk`` and ``place``: rows in the order of their partitions, ``chunk_size`` to a chunk.

    df must be a table scan: it is read twice, in the same partitions. One count a partition
    comes to the driver.
    """
    return _numbered(df, chunk_size)[0]


def render(mapping: Mapping, records: DataFrame) -> DataFrame:
    """(ttl, jsonld, nt): every record in three syntaxes, from one scan."""
    return records.select(mapping.turtle().alias("ttl"), mapping.jsonld().alias("jsonld"), mapping.ntriples().alias("nt"))


@dataclass
class _Written(WriterCommitMessage):
    pieces: list


def _text_of(column: pa.StringArray, i: int, j: int) -> memoryview:
    """The bytes of the rows i to j - 1, which lie next to each other."""
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    at = memoryview(offsets).cast("q" if wide else "i")
    return memoryview(data)[at[column.offset + i] : at[column.offset + j]] if data is not None else memoryview(b"")


class _ChunkWriter(DataSourceArrowWriter):
    """Rows (chunk, place, ttl, jsonld, nt) in the order of their places: a file for each chunk that a task has rows of.

    A file that begins a chunk has its head, one that ends a whole chunk has its end. JSON-LD comes with a
    comma before every record. The committed files are listed in pieces.json.
    """

    def __init__(self, options: dict) -> None:
        self.path, self.header, self.size = options["path"], options["header"], int(options["chunk_size"])

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Written:
        system, at = open_path(self.path)
        attempt, pieces, open_ = uuid.uuid4().hex, [], {}

        def close() -> None:
            if open_:
                if sum(pieces[-1][1:3]) % self.size == 0:
                    open_["jsonld"].write(b"\n]\n")
                for f in open_.values():
                    f.close()
                open_.clear()

        for batch in iterator:
            chunks, first = batch.column("chunk").to_numpy(), batch.column("place")[0].as_py() if batch.num_rows else 0
            i = 0
            while i < len(chunks):
                chunk = int(chunks[i])
                j = i + int((chunks[i:] == chunk).sum())
                fresh = (first + i) % self.size == 0
                if not pieces or pieces[-1][0] != chunk or not open_:
                    close()
                    pieces.append([chunk, first + i, 0, f"{chunk:04d}.{first + i:016d}.{attempt}"])
                    for kind in FORMATS:
                        open_[kind] = system.open_output_stream(f"{at}/{pieces[-1][3]}.{kind}")
                    if fresh:
                        open_["ttl"].write(self.header.encode())
                        open_["jsonld"].write(b"[")
                open_["ttl"].write(_text_of(batch.column("ttl"), i, j))
                open_["jsonld"].write(_text_of(batch.column("jsonld"), i, j)[1 if fresh else 0 :])
                open_["nt"].write(_text_of(batch.column("nt"), i, j))
                pieces[-1][2] += j - i
                i = j
        close()
        return _Written(pieces)

    def commit(self, messages: list) -> None:
        _put(f"{self.path}/pieces.json", json.dumps([p for m in messages if m for p in m.pieces]))

    def abort(self, messages: list) -> None:
        """Files of attempts that don't count go with the folder of the run."""


class RdfChunks(DataSource):
    @classmethod
    def name(cls) -> str:
        return "rdf_chunks"

    def schema(self) -> str:
        return "chunk int, place long, ttl string, jsonld string, nt string"

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return _ChunkWriter(self.options)


def _put(path: str, text: str) -> None:
    system, at = open_path(path)
    with system.open_output_stream(at) as f:
        f.write(text.encode())


def _get(path: str) -> str:
    system, at = open_path(path)
    with system.open_input_stream(at) as f:
        return f.read().decode()


def _joined(spark: SparkSession, pieces: list, folder: str, out: str, chunk_size: int) -> None:
    """Chunk files in ``out`` from the pieces in ``folder``, a chunk to a row; whole pieces are renamed."""
    chunks: dict[int, list] = {}
    for chunk, place, rows, name in sorted(pieces, key=lambda p: p[1]):
        chunks.setdefault(chunk, []).append((rows, name))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = open_path(folder)
        source, target = open_path(folder)[1], open_path(out)[1]
        for batch in batches:
            for chunk, names, rows in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for kind in FORMATS:
                    done, parts = f"{target}/{kind}/chunk_{chunk:04d}.{kind}", [f"{source}/{n}.{kind}" for n in names]
                    if len(parts) == 1 and rows == chunk_size:
                        # a task that runs again finds the file where it has put it
                        if system.get_file_info(parts[0]).type != fs.FileType.NotFound:
                            system.move(parts[0], done)
                        continue
                    hidden = f"{target}/{kind}/.{uuid.uuid4().hex}"
                    with system.open_output_stream(hidden) as f:
                        for part in parts:
                            with system.open_input_stream(part) as g:
                                while block := g.read(1 << 20):
                                    f.write(block)
                        if kind == "jsonld" and rows < chunk_size:
                            f.write(b"\n]\n")
                    system.move(hidden, done)
            yield pa.RecordBatch.from_arrays([batch.column(0)], ["chunk"])

    rows = [(chunk, [n for _, n in parts], sum(n for n, _ in parts)) for chunk, parts in chunks.items()]
    table = spark.createDataFrame(rows, "chunk int, names array<string>, rows long").repartition(max(1, min(len(rows), 10_000)), "chunk")
    table.mapInArrow(run, "chunk int").count()


def write_chunks(rendered: DataFrame, header: str, output: str, chunk_size: int = CHUNK_SIZE) -> tuple[int, int]:
    """Write staged rows (ttl, jsonld, nt); (chunks, rows) written. The files of an earlier run are replaced at the end."""
    system, at = open_path(output)
    run = f"_run_{uuid.uuid4().hex}"
    for folder in ("pieces", *(f"new/{k}" for k in FORMATS), "old"):
        system.create_dir(f"{at}/{run}/{folder}", recursive=True)
    spark = rendered.sparkSession
    spark.dataSource.register(RdfChunks)
    try:
        numbered, total = _numbered(rendered, chunk_size)
        if total:
            shown = numbered.select("chunk", "place", "ttl", F.concat(F.lit(",\n"), "jsonld").alias("jsonld"), "nt")
            shown.write.format("rdf_chunks").option("header", header).option("chunk_size", chunk_size).mode("append").save(f"{output}/{run}/pieces")
            _joined(spark, json.loads(_get(f"{output}/{run}/pieces/pieces.json")), f"{output}/{run}/pieces", f"{output}/{run}/new", chunk_size)
        for kind in FORMATS:
            with contextlib.suppress(FileNotFoundError, OSError):
                system.move(f"{at}/{kind}", f"{at}/{run}/old/{kind}")
            system.move(f"{at}/{run}/new/{kind}", f"{at}/{kind}")
    finally:
        with contextlib.suppress(OSError):
            system.delete_dir(f"{at}/{run}")
    return -(-total // chunk_size), total


def _now() -> str:
    return datetime.now(UTC).isoformat()


class _Progress(threading.Thread):
    """Rewrites progress.json, and says so on the console, whenever more chunks are done."""

    def __init__(self, output: str, facts: dict, chunk_size: int) -> None:
        super().__init__(daemon=True)
        self.output, self.facts, self.chunk_size, self.ended, self.seen = output, facts, chunk_size, threading.Event(), 0

    def look(self) -> None:
        system, at = open_path(self.output)
        runs = [x.path for x in system.get_file_info(fs.FileSelector(at)) if x.base_name.startswith("_run_")]
        done = 0
        for run in runs:
            with contextlib.suppress(OSError):
                done += sum(not x.base_name.startswith(".") for x in system.get_file_info(fs.FileSelector(f"{run}/new/nt")))
        if done > self.seen:
            self.seen = done
            self.write(chunks_completed=done, records_processed=done * self.chunk_size)

    def write(self, **facts) -> None:
        self.facts |= facts
        _put(f"{self.output}/progress.json", json.dumps(self.facts, indent=2))
        print(f"{self.facts['chunks_completed']} chunks, {self.facts['records_processed']} records", file=sys.stderr)

    def run(self) -> None:
        while not self.ended.wait(PROGRESS_SECONDS):
            with contextlib.suppress(OSError):
                self.look()


def convert(spark: SparkSession, source: str, path: str, output: str = "./output", chunk_size: int = CHUNK_SIZE, digest: bool = True) -> dict:
    """Convert a dump to chunk files of three syntaxes; returns the manifest, which is written too.

    Bad rows are counted and appended to errors.log, a folder of text files. ``digest`` reads a single input
    file a second time, beside the conversion, as the manifest's MD5 needs.
    """
    from ..sources import read_source
    from .specs import MAPPINGS

    system, at = open_path(output)
    system.create_dir(at, recursive=True)
    mapping = MAPPINGS[source]()
    stage = f"_rendered_{uuid.uuid4().hex}"
    progress = _Progress(output, {"source_file": path, "source_size": 0, "source_md5": "", "chunks_completed": 0, "records_processed": 0, "records_skipped": 0, "started_at": _now()}, chunk_size)
    with ThreadPoolExecutor(1) as beside:
        print_of = beside.submit(fingerprint, path) if digest and files(path) == [path] else None
        progress.start()
        try:
            _stage(read_source(spark, source, path), mapping, f"{output}/{stage}")
            rows = spark.read.parquet(f"{output}/{stage}")
            chunks, records = write_chunks(rows.filter("error IS NULL").select(*FORMATS), mapping.turtle_header(), output, chunk_size)
            bad = rows.filter("error IS NOT NULL")
            skipped = bad.count()
            if skipped:
                line = F.concat_ws(": ", "error", F.coalesce("accession", F.lit("-")), F.translate("message", "\r\n", "  "))
                bad.select(line.alias("value")).write.mode("append").text(f"{output}/errors.log")
        finally:
            progress.ended.set()
            progress.join()
            with contextlib.suppress(OSError):
                system.delete_dir(f"{at}/{stage}")
        md5, size = print_of.result() if print_of else ("", 0)
    manifest = {"source_file": path, "source_md5": md5, "total_chunks": chunks, "total_records": records, "records_skipped": skipped, "completed_at": _now()}
    progress.write(source_size=size, source_md5=md5, chunks_completed=chunks, records_processed=records, records_skipped=skipped)
    _put(f"{output}/manifest.json", json.dumps(manifest, indent=2))
    return manifest


def _stage(parsed: Parsed, mapping: Mapping, path: str) -> None:
    """One pass over the input: rendered records and errors, side by side, as Parquet."""
    good = F.col("error").isNull()
    shown = [F.when(good, x).alias(n) for n, x in (("ttl", mapping.turtle()), ("jsonld", mapping.jsonld()), ("nt", mapping.ntriples()))]
    rows = parsed.rows.select(F.col("accession").alias("__accession"), "error", "message", "record.*")
    spark = rows.sparkSession
    before = spark.conf.get(HUGE_METHOD)
    # longer methods than the JVM compiles are split into many, instead of being interpreted
    spark.conf.set(HUGE_METHOD, "8000")
    try:
        rows.select("error", F.col("__accession").alias("accession"), "message", *shown).write.parquet(path)
    finally:
        spark.conf.set(HUGE_METHOD, before)


def load_progress(output: str) -> dict | None:
    """progress.json of an earlier run, None without one."""
    try:
        return json.loads(_get(f"{output}/progress.json"))
    except FileNotFoundError:
        return None


def summary(spark: SparkSession, outputs: dict[str, str]) -> DataFrame:
    """(source, total_chunks, total_records, records_skipped) from the manifests of several outputs, and their sum as ``all``."""
    found = [(source, json.loads(_get(f"{path}/manifest.json"))) for source, path in outputs.items()]
    rows = spark.createDataFrame([(s, m["total_chunks"], m["total_records"], m["records_skipped"]) for s, m in found], "source string, total_chunks long, total_records long, records_skipped long")
    return rows.unionByName(rows.agg(F.lit("all").alias("source"), *[F.sum(c).alias(c) for c in rows.columns[1:]]))
