"""Shared plumbing: staged tables, Arrow batch sizes, graph components."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes of an Arrow batch handed to Python; texts may be long, so batches are short.
BATCH_ROWS, BATCH_BYTES = 500, 8 << 20


def prepare(spark: SparkSession) -> None:
    """Keep Arrow batches of whole texts small enough for a Python worker: the session's setting, if not smaller already."""
    for name, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        name = f"spark.sql.execution.arrow.{name}"
        now = str(spark.conf.get(name)).lower().removesuffix("b")
        if not now.isdecimal() or not 0 < int(now) <= most:
            spark.conf.set(name, str(most))


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``, else, in local mode, one of our own."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="stages_")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def stage_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/stage_{label}_{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write df to the shared folder and read it back: lineage ends in a table that outlives executors."""
    spark = df.sparkSession
    path = stage_path(spark, label)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stage_path = path
    return out


def drop_stage(df: DataFrame) -> None:
    """Delete a staged table that nothing reads any more."""
    path = getattr(df, "_stage_path", None)
    if path:
        spark = df.sparkSession
        jvm = spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that df does not have."""
    taken = {c.lower() for c in df.columns}
    return next(n for k in range(len(taken) + 1) if (n := f"__{stem}{k or ''}") not in taken)


def shuffle_parts(spark: SparkSession, rows: int, rows_per_task: int) -> int:
    """Partitions for a keyed exchange: the session's number, or more if tasks would get too many rows."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // rows_per_task))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges(a, b)``: (v, root) for every vertex, root the least vertex.

    Every round sends each vertex to its least neighbour, follows those pointers to their ends
    by doubling, and contracts the edges. A round leaves only local minima, at most half of the
    vertices of a component, so rounds grow with the logarithm of the component's size. Hubs are
    safe: minima are combined map-side, and joins on a hub's key have one row on the other side.
    An empty edge table gives an empty result; self-loops and repeated edges are ignored.
    """
    both = edges.filter("a <> b").select("a", "b")
    live = stage(both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    total = None
    while not live.isEmpty():
        up = stage(live.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("m")).select("v", F.least("v", "m").alias("p")), "up")
        while True:
            far = up.select(F.col("v").alias("p"), F.col("p").alias("pp"))
            hop = stage(up.join(far, "p", "left").select("v", F.coalesce("pp", "p").alias("p"), (F.coalesce("pp", "p") != F.col("p")).alias("moved")), "hop")
            moved = not hop.filter("moved").isEmpty()
            drop_stage(up)
            up = hop.select("v", "p")
            up._stage_path = hop._stage_path
            if not moved:
                break
        if total is None:
            total, gone = stage(up.select("v", F.col("p").alias("root")), "roots"), None
        else:
            gone = total
            far = up.select(F.col("v").alias("root"), F.col("p").alias("pp"))
            total = stage(total.join(far, "root", "left").select("v", F.coalesce("pp", "root").alias("root")), "roots")
        one = up.select(F.col("v").alias("a"), F.col("p").alias("pa"))
        two = up.select(F.col("v").alias("b"), F.col("p").alias("pb"))
        nxt = stage(live.join(one, "a").join(two, "b").filter("pa <> pb").select(F.col("pa").alias("a"), F.col("pb").alias("b")).distinct(), "edges")
        for old in (live, up, gone):
            if old is not None:
                drop_stage(old)
        live = nxt
    if total is None:
        return live.select(F.col("a").alias("v"), F.col("b").alias("root"))
    return total
