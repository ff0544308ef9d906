"""Line dedup with levelled sorted runs of line hashes.

Built-in functions only. Documents come in batches. The store holds sorted runs of (line hash, number of documents), all
in the same buckets by hash and sorted within; each new batch is merge-anti-joined with the run of settled hashes, so lines
that are already known to go cost no more counting, and adds what is left as a run of level 0. When a level holds two runs
they are merged into one run of the next level, and hashes that reach the threshold move to the settled run. As all runs
lie in the same buckets in the same order, merges shuffle and sort nothing: only a batch's own hashes are dealt out, once,
and counts of different levels when the frequent hashes are asked for. The store has a folder with a manifest of its runs, so a later session opens it and adds further batches; a batch
that fails leaves the manifest as it was.

Defined results: a null text counts as one empty line; empty lines (keys shorter than `min_chars`) always stay; a line
repeated within one document counts that document once; repeated rows of one doc_id are separate documents, also where
they are alike or have no id; texts are split as a whole, however long; an empty table gives an empty result; only the
id and text columns are read, so others may have any name.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.store import drop, open_buckets, write_buckets
from .common import BLANKS, saved, scratch_dir

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(BLANKS)), _UPPER, _LOWER)


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_hashes(text: Column, min_chars: int) -> Column:
    """One 128-bit hash (two longs) per line, null for lines that are too short to be judged."""
    keyed = F.transform(_lines(text), line_key)
    return F.transform(
        keyed,
        lambda k: F.when(F.char_length(k) >= min_chars, F.struct(F.xxhash64(k).alias("h1"), F.xxhash64(F.lit(1), k).alias("h2"))),
    )


_KEY, _SCHEMA, _ORDERED = ("h1", "h2"), "h1 long, h2 long, n long", "spark.sql.legacy.bucketedTableScan.outputOrdering"


@contextmanager
def _in_order(spark: SparkSession) -> Iterator[None]:
    """Within, scans of buckets tell that their files are sorted, so merges need no sort; each bucket of a run is one file."""
    before = spark.conf.get(_ORDERED)
    spark.conf.set(_ORDERED, "true")
    try:
        yield
    finally:
        spark.conf.set(_ORDERED, before)


def merge(a: DataFrame, b: DataFrame) -> DataFrame:
    """Two runs as one, with the sums of their counts, by one merge of both in order."""
    both = a.hint("merge").join(b.withColumnRenamed("n", "m").hint("merge"), list(_KEY), "full_outer")
    return both.select(*_KEY, (F.coalesce("n", F.lit(0)) + F.coalesce("m", F.lit(0))).alias("n"))


class LineRuns:
    """The levelled store in a folder, made there or opened; add() takes the distinct line hashes of a batch of documents, one row (h1, h2) a document and line."""

    def __init__(self, spark: SparkSession, path: str, threshold: int):
        self.spark, self.path, self.threshold = spark, path, threshold
        self.runs: list[tuple[int, DataFrame]] = []  # level and run; level -1 is the settled run
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/manifest-*")
        found = hadoop.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).globStatus(hadoop) or []
        self.version = max((int(f.getPath().getName().rpartition("-")[2]) for f in found), default=0)
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        if self.version:
            held = spark.read.schema("level int, name string, buckets int").json(f"{path}/manifest-{self.version}").collect()  # a few runs a level
            self.buckets = held[0].buckets
            self.runs = [(r.level, open_buckets(spark, f"{path}/{r.name}", _SCHEMA, _KEY, (), r.buckets)) for r in held if r.name]

    def level(self, k: int) -> list[DataFrame]:
        return [r for level, r in self.runs if level == k]

    def _write(self, df: DataFrame) -> DataFrame:
        """df, grouped or joined on its key, as a run."""
        return write_buckets(df, f"{self.path}/run-{uuid.uuid4().hex}", _KEY, (), self.buckets, deal=False)

    def _count(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*_KEY).agg(F.sum("n").alias("n"))

    def _publish(self, runs: list[tuple[int, DataFrame]]) -> None:
        """From now on the store is these runs; the others' files go when the manifest tells so."""
        rows = [(level, r._store[1].rpartition("/")[2], self.buckets) for level, r in runs] or [(0, None, self.buckets)]
        self.version += 1
        self.spark.createDataFrame(rows, "level int, name string, buckets int").coalesce(1).write.json(f"{self.path}/manifest-{self.version}")
        stay = {r._store[0] for _, r in runs}
        gone, self.runs = [r for _, r in self.runs if r._store[0] not in stay], runs
        for r in gone:
            drop(r)

    def add(self, batch: DataFrame) -> None:
        before = self.spark.conf.get("spark.sql.shuffle.partitions")
        self.spark.conf.set("spark.sql.shuffle.partitions", str(self.buckets))
        try:
            with _in_order(self.spark):
                self._add(batch)
        finally:
            self.spark.conf.set("spark.sql.shuffle.partitions", before)

    def _add(self, batch: DataFrame) -> None:
        run = self._write(self._count(batch.withColumn("n", F.lit(1).cast("long"))))
        for settled in self.level(-1):
            fresh = self._write(run.hint("merge").join(settled.select(*_KEY).hint("merge"), list(_KEY), "left_anti"))
            drop(run)
            run = fresh
        runs, level, extra = [*self.runs, (0, run)], 0, []
        while len(at := [r for k, r in runs if k == level]) == 2:
            merged = self._write(merge(*at))
            done, old = merged.where(F.col("n") >= self.threshold), [r for k, r in runs if k == -1]
            settled = self._write(merge(done, old[0]) if old else done)  # one that was settled since may be in an old run, too
            rest = self._write(merged.where(F.col("n") < self.threshold))
            extra += [merged, *at, *old]
            runs, level = [*((k, r) for k, r in runs if k not in (-1, level)), (-1, settled), (level + 1, rest)], level + 1
        known = {r._store[0] for _, r in self.runs}
        self._publish(runs)
        stay = {r._store[0] for _, r in runs}
        for r in extra:
            if r._store[0] not in known | stay:
                drop(r)

    def frequent(self) -> DataFrame | None:
        """(h1, h2) of all hashes seen in at least `threshold` documents."""
        counted = [r for level, r in self.runs if level >= 0]
        parts = [r.select(*_KEY) for r in self.level(-1)]
        if counted:
            parts.append(self._count(_union(counted)).where(F.col("n") >= self.threshold).select(*_KEY))
        return _union(parts).distinct() if parts else None


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def drop_frequent_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 10, min_chars: int = 1, batches: int = 4, store_path: str | None = None) -> DataFrame:
    """(id, text, n_lines, n_dropped): each text without the lines whose key occurs in at least min_docs documents.

    store_path: a store whose earlier documents count, too, and that keeps these; without it only docs count.
    """
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # A row's own key, so that repeated ids stay apart; xxhash64 of the text keeps reruns of a lost task in agreement.
    src = src.withColumn("row", F.xxhash64("id", "text"))
    hashes = saved(
        src.select("id", "row", F.pmod("row", F.lit(batches)).cast("int").alias("batch"), line_hashes(F.col("text"), min_chars).alias("lines")).select(
            "id", "row", "batch", F.posexplode("lines").alias("pos", "h")
        ).where("h is not null").select("id", "row", "batch", "pos", "h.h1", "h.h2"),
        "lines",
    )
    # Rows that agree in id and text come out alike, so they are counted by how many rows stand for them.
    copies = src.groupBy("row", "id").agg(F.count("*").alias("rows")).where("rows > 1")
    repeated = copies.limit(1).count() > 0
    store = LineRuns(docs.sparkSession, store_path or f"{scratch_dir(docs.sparkSession)}/store-{uuid.uuid4().hex}", min_docs)
    for b in range(batches):
        one = hashes.where(F.col("batch") == b)
        if repeated:
            one = one.groupBy("id", "row", "h1", "h2").agg(F.first("batch").alias("batch"), F.count("*").alias("k"))
            one = one.join(copies.withColumnRenamed("row", "r").withColumnRenamed("id", "i"), (F.col("row") == F.col("r")) & F.col("id").eqNullSafe(F.col("i")), "left")
            one = one.withColumn("rows", F.coalesce("rows", F.lit(1))).withColumn("rep", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int")))).select("h1", "h2")
        else:
            one = one.select("id", "row", "h1", "h2").distinct().select("h1", "h2")
        store.add(one)
    frequent = store.frequent()
    gone = hashes.join(frequent, ["h1", "h2"], "left_semi").groupBy("id", "row").agg(F.array_distinct(F.collect_list("pos")).alias("gone"))
    lines = _lines(F.col("text"))
    joined = src.join(gone.withColumnRenamed("id", "i").withColumnRenamed("row", "r"), (F.col("row") == F.col("r")) & F.col("id").eqNullSafe(F.col("i")), "left")
    kept = F.when(F.col("gone").isNull(), F.col("text")).otherwise(
        F.array_join(
            F.transform(
                F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone")),
                lambda i: F.get(F.col("lines"), i),
            ),
            "\n",
        )
    )
    return joined.withColumn("lines", lines).select(
        F.col("id").alias(id_col),
        F.coalesce(kept, F.lit("")).alias(text_col),
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
    )
