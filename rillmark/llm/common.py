"""Helpers shared by the corpus operators: durable scratch tables, global ranks, connected components."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The characters that separate words, and that are stripped from lines.
BLANKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """name, or the first of name_, name__, ... that is no column of df in any case."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def scratch_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a temporary one only where that is unset and all of Spark is on this machine, as in tests."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.rillmark.scratch", None)
    if not path:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = f"file://{tempfile.mkdtemp(prefix='spark-scratch-', dir='/tmp')}"
        spark.conf.set("spark.rillmark.scratch", path)
    return path


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write df as a table in the shared scratch folder and read it back: lineage is cut, and a lost executor costs no work done before.

    The shuffle files of the write go as soon as it ends, as nothing reads them again.
    """
    conf, path = df.sparkSession.conf, f"{scratch_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    before = conf.get(_CLEANUP, "false")
    conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        conf.set(_CLEANUP, before)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back._scratch_path = path
    return back


def forget(*tables: DataFrame) -> None:
    """Delete the files of tables that saved() wrote and that nothing reads any more."""
    for df in tables:
        path = getattr(df, "_scratch_path", None)
        if path:
            jvm = df.sparkSession._jvm
            hadoop = jvm.org.apache.hadoop.fs.Path(path)
            hadoop.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(hadoop, True)


def with_rank(df: DataFrame, *order: str, name: str = "rank") -> tuple[DataFrame, int]:
    """df with the gapless 0-based position of each row in the global order, and the number of rows.

    Rows are range-partitioned and sorted in parallel and written once; only one count per partition reaches the
    driver, so no task sees the whole order.
    """
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    table = saved(placed, "ranked")
    parts = sorted(table.groupBy(F.shiftright("_at", 33).alias("part")).agg(F.count("*").alias("n")).collect())
    starts, total = [], 0
    for part, n in parts:
        starts.append((part, total))
        total += n
    offsets = df.sparkSession.createDataFrame(starts, "_part long, _start long")
    ranked = (
        table.withColumn("_part", F.shiftright("_at", 33))
        .join(F.broadcast(offsets), "_part")  # one row per partition of the sort
        .withColumn(name, F.col("_start") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("_part", "_start", "_at")
    )
    return ranked, total


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for each end of the undirected edges (u, v): the smallest id that it reaches.

    Each round looks up the label of each label, and takes the least of those among a vertex's neighbours. That lowers
    the label of the vertex and also the label of its old label, so whole trees are hooked at their roots, and a chain
    settles in about log n rounds, whatever the order of its ids. Labels only fall, and no label is above its vertex or
    outside its component, so the loop ends; it ends only when no label moves, and then each component has one label,
    its least id. Every step is an aggregate with map-side combine or an equi-join whose other side has one row a key,
    which adaptive execution can split where a key is hot.
    """
    both = saved(edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).where("u <> v").distinct(), "edges")
    labels = saved(both.groupBy(F.col("u").alias("id")).agg(F.least(F.first("u"), F.min("v")).alias("component")), "labels")
    while True:
        own = labels.select("id", "component")
        top = own.select(F.col("id").alias("component"), F.col("component").alias("top"))
        grand = saved(own.join(top, "component").select("id", "component", "top"), "grand")
        near = both.join(grand, both.v == grand.id).groupBy("u").agg(F.min("top").alias("near"))
        step = saved(grand.join(near, grand.id == near.u).select("id", "component", F.least("top", "near").alias("next")), "step")
        roots = step.groupBy(F.col("component").alias("id")).agg(F.min("next").alias("hook"))
        lowered = step.join(roots, "id", "left").withColumn("next", F.least("next", "hook"))
        after = saved(lowered.select("id", F.col("next").alias("component"), (F.col("next") < F.col("component")).alias("moved")), "labels")
        forget(labels, grand, step)
        labels = after
        if after.where("moved").limit(1).count() == 0:
            break
    forget(both)
    out = labels.select("id", "component")
    out._scratch_path = labels._scratch_path
    return out
