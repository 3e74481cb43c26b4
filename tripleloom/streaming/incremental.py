"""Accession rows as a stream: new TSV files in a folder are parsed by the batch scan's own plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.specs import MAPPINGS
from ..sources import Parsed
from ..sources.scan import sra_rows


def stream_sra(spark: SparkSession, folder: str) -> Parsed:
    """Records and errors of the files that appear in a folder."""
    lines = spark.readStream.schema("value string").text(folder)
    return sra_rows(lines.select(F.col("_metadata.file_path").alias("file"), "value"))


def append_triples(parsed: Parsed, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Append the triples of new records to a Parquet table; the checkpoint makes each file count once."""
    triples: DataFrame = MAPPINGS["sra"]().triples(parsed.records)
    return triples.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
