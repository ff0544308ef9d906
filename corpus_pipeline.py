"""A corpus pipeline of five stages; each function takes (spark, docs, sf_dir) and works on all that the one before kept.

language   documents that the language models reject, or that have no letters, go
near       of each group of rows that are linked at 0.8 by five-word shingles, one with the smallest id stays
benchmark  documents that hold at least 0.8 of a benchmark item's five-word shingles go
mix        each row is repeated as often as the mix of sources takes it
shards     the rows get their shard and slot along the Hilbert curve

Stages decide on rows: rows that share an id are told apart, repeated rows are near duplicates of each other, and rows
without an id count like others (their id comes after all others). Null and empty texts have no letters and leave with
the first stage; run alone, the others keep them, each a group of its own. Ties go to the smaller hash of the text, then
to either row, as these are alike. Texts count as a whole, however long; an empty table gives an empty one. Stages keep
the columns of documents, whatever they are and however they are named; the last adds shard and slot, in the place of
columns of these names. A table without labels loses only rows without letters in the first stage. Each stage is written
as Parquet and read again before the next, and deleted when that one is written.

Near duplicates and the mix decide on narrow rows. The rows with their texts are written once, in buckets by the part that
they were read in; what is decided comes back as one array a part, with a value for each row at its place, so no text is
shuffled for it. A part has as many rows as one task reads.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillmark.llm import cube_mix, hilbert, jaccard_skip, kn_langid, minhash_contain
from rillmark.llm.common import forget, free_name, saved, scratch_dir
from rillmark.sources.store import write_buckets


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = kn_langid.train(docs, F.lit(True), crossed=True)
    return kn_langid.keep_accepted(docs, model)


def _numbered(docs: DataFrame) -> tuple[DataFrame, str, str]:
    """docs, written with the part that a row was read in and its number, so that every later read sees the same ones, and the names of these columns."""
    part, number = free_name(docs, "part"), free_name(docs, "number")
    rows = docs.withColumn(part, F.spark_partition_id()).withColumn(number, F.monotonically_increasing_id())
    return write_buckets(rows, f"{scratch_dir(docs.sparkSession)}/rows-{uuid.uuid4().hex}", (part,), deal=False), part, number


def _decided(rows: DataFrame, part: str, number: str, values: DataFrame, name: str) -> DataFrame:
    """rows with the value (number, value) of each as the column name; values has each row of each part once."""
    place = F.col("number").bitwiseAND(F.lit((1 << 33) - 1))
    held = values.groupBy(F.shiftright("number", 33).cast("int").alias(part)).agg(F.array_sort(F.collect_list(F.struct(place.alias("at"), "value"))).alias("of"))
    array = free_name(rows, "values")
    held = held.select(part, F.transform("of", lambda x: x["value"]).alias(array))
    own = F.col(number).bitwiseAND(F.lit((1 << 33) - 1)).cast("int")
    return rows.hint("merge").join(held.hint("merge"), part).withColumn(name, F.get(array, own)).drop(array)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows, part, n = _numbered(docs)
    number = F.col(n).alias("number")
    groups = jaccard_skip.linked_documents(rows.select(number, "text"), k=5, percent=80, id_col="number")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.xxhash64("text").alias("tie"), number)
    named = groups.join(rows.select(number, order.alias("first")), "number")
    first = named.groupBy("component_id").agg(F.min("first").alias("least")).select("component_id", F.col("least.number").alias("stays"))
    stays = named.select("number", "component_id").join(first, "component_id").select("number", (F.col("number") == F.col("stays")).cast("tinyint").alias("value"))
    stay = free_name(rows, "stay")
    return _decided(rows, part, n, stays, stay).where(F.col(stay) == 1).select(*docs.columns)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return minhash_contain.without_items(docs, items, k=5, least=0.8)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows, part, n = _numbered(docs)
    units = rows.select(F.coalesce("doc_id", F.lit(-1)).alias("doc_id"), "source", "text", F.col(n).alias("number"))
    copies = cube_mix.mix_sources(units, carried=("number",)).select("number", F.col("copies").cast("tinyint").alias("value"))
    times = free_name(rows, "copies")
    taken = _decided(rows, part, n, copies, times).where(F.col(times) > 0)
    return taken.withColumn(free_name(taken, "copy"), F.explode(F.sequence(F.lit(1), F.col(times).cast("int")))).select(*docs.columns)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return hilbert.with_shards(docs, n_shards=8)


STAGES = [("language", language), ("near", near), ("benchmark", benchmark), ("mix", mix), ("shards", shards)]

#: The models of the first stage and the sampling of the fourth have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        before, docs = docs, saved(stage(spark, docs, sf_dir), f"stage-{name}")
        forget(before)
    return docs
