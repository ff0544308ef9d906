"""Co-partitioned tables: bucketed Parquet that joins, groups and windows on its keys read without a shuffle."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch(spark: SparkSession) -> str | None:
    """A folder for tables that live as long as the session: in spark.checkpoint.dir, or where that is unset a temporary one if all of Spark is on this machine, else none."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.rillmark.store", None)
    if not path and re.match(r"local(\[|$)", spark.sparkContext.master):
        path = f"file://{tempfile.mkdtemp(prefix='spark-store-', dir='/tmp')}"
        spark.conf.set("spark.rillmark.store", path)
    return path


def _opened(spark: SparkSession, name: str, path: str) -> DataFrame:
    # Spark 4.1 takes a union of bucketed scans for co-partitioned but does not run it so, and a group over it is wrong.
    spark.conf.set("spark.sql.unionOutputPartitioning", "false")
    out = spark.table(name)
    out._store = (name, path)
    return out


def _quoted(names: tuple[str, ...]) -> str:
    return ", ".join(f"`{n}`" for n in names)


def write_buckets(df: DataFrame, path: str, by: tuple[str, ...], order: tuple[str, ...] = (), buckets: int | None = None, deal: bool = True) -> DataFrame:
    """Write df to a new path, in buckets by hash of `by`, sorted by `by` and `order` within; the table that reads it.

    Rows are dealt out as the buckets are, so each task writes one file. buckets: as many as shuffle partitions by default.
    deal: False where df comes from a group or join on `by`, which has dealt its rows out already.
    """
    n = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    name = f"store_{uuid.uuid4().hex}"
    dealt = df.repartition(n, *by).sortWithinPartitions(*by, *order) if deal else df
    dealt.write.format("parquet").bucketBy(n, *by).sortBy(*by, *order).option("compression", "zstd").option("path", path).saveAsTable(name)
    return _opened(df.sparkSession, name, path)


def open_buckets(spark: SparkSession, path: str, schema: str, by: tuple[str, ...], order: tuple[str, ...], buckets: int) -> DataFrame:
    """A table that write_buckets() wrote, also in another session: keys, order and number of buckets as they were written."""
    name = f"store_{uuid.uuid4().hex}"
    spark.sql(f"create table {name} ({schema}) using parquet clustered by ({_quoted(by)}) sorted by ({_quoted((*by, *order))}) into {buckets} buckets location '{path}'")
    return _opened(spark, name, path)


def drop(table: DataFrame) -> None:
    """Forget a table and delete its files."""
    spark, (name, path) = table.sparkSession, table._store
    spark.sql(f"drop table if exists {name}")
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(hadoop, True)


def stamp(spark: SparkSession, *paths: str) -> tuple[int, ...]:
    """When each of the paths changed last."""
    out = []
    for p in paths:
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(p)
        out.append(hadoop.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).getFileStatus(hadoop).getModificationTime())
    return tuple(out)


class Kept:
    """Tables that several queries of a session read, derived once: written in buckets by their first key, or persisted where there is no folder to write to.

    Neither clearing Spark's cache nor a lost executor loses a written table; one whose sources have changed is derived
    again. release() deletes all.
    """

    def __init__(self) -> None:
        self.tables: dict[tuple, tuple[tuple, DataFrame]] = {}

    def get(self, spark: SparkSession, name: tuple, make, sources: tuple[str, ...], by: tuple[str, ...] = ("street",), order: tuple[str, ...] = (), buckets: int | None = None, deal: bool = True) -> DataFrame:
        key, now = (id(spark._jsparkSession), *name), stamp(spark, *sources)
        held = self.tables.get(key)
        if held and held[0] == now and (hasattr(held[1], "_store") or held[1].storageLevel.useMemory or held[1].storageLevel.useDisk):
            return held[1]
        if held:
            self._let_go(held[1])
        folder = scratch(spark)
        df = write_buckets(make(), f"{folder}/kept-{uuid.uuid4().hex}", by, order, buckets, deal) if folder else make().persist()
        self.tables[key] = (now, df)
        return df

    @staticmethod
    def _let_go(df: DataFrame) -> None:
        if hasattr(df, "_store"):
            drop(df)
        else:
            df.unpersist()

    def release(self) -> None:
        for _, df in self.tables.values():
            self._let_go(df)
        self.tables.clear()
