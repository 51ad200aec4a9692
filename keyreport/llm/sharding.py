"""Shuffled shards by a two-pass external shuffle, in DataFrame operations only.

Pass one scatters the records uniformly, by a seeded hash of record and row number,
into as many buckets as make each one fit a task's memory, and writes them. Pass
two gathers one bucket at a time, permutes it (``shuffle`` is Spark's Fisher-Yates)
and numbers its records on from all earlier buckets. Record number g goes to
shard g mod n, slot g div n: shard sizes differ by one record at most (law ``rows``).

``write_shards`` writes each bucket's records where they were permuted, without another
shuffle: a folder per shard, a file per bucket in it, in slot order. A bucket's records go
through the shuffle whole, so ``bucket_bytes`` is what a task holds a few times over.

The row number is part of the hash, so records that share an id, a source or a
text (groups of equal texts) spread like any others, each with a slot of its own, and no
bucket depends on a key. Buckets are written
before their permutation, so a lost executor changes neither. The same seed, input
files and settings give the same shards.

Defined results: a null text has no bytes; null ids are kept; repeated rows each
get their own slot; an empty table gives no rows. Input columns stay inside the
struct column ``record``, so their names can't clash with the added ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from keyreport.llm.common import join_small, table, written
from keyreport.llm.queries import query
from keyreport.session import scratch_dir

SHARDS = 8
BUCKET_BYTES = 32 << 20
# Buckets whose offsets are summed in one group.
OFFSET_GROUP = 1024
SEED = 42


def shuffle_shards(docs: DataFrame, size: Column, shards: int = SHARDS, bucket_bytes: int = BUCKET_BYTES,
                   seed: int = SEED) -> DataFrame:
    """One row per record: record (the input's columns), size, shard, slot."""
    rows = docs.select(F.struct("*").alias("record"), size.cast("long").alias("size"),
                       F.monotonically_increasing_id().alias("row"))
    total = docs.agg(F.coalesce(F.sum(size), F.lit(0)).alias("b")).first()["b"]
    buckets = max(1, -(-int(total) // bucket_bytes))
    rows = rows.withColumn("key", F.xxhash64(F.lit(seed), "row", "size"))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64(F.lit(seed + 1), "key"), F.lit(buckets)).cast("int"))
    rows = written(rows, "sharding-buckets", "zstd")
    base = written(bucket_offsets(rows), "sharding-offsets")
    bucket = (rows.repartitionById(buckets, F.col("bucket")).groupBy("bucket")
              .agg(F.sort_array(F.collect_list(F.struct("key", "row", "record", "size"))).alias("all"))
              .sortWithinPartitions("bucket").select("bucket", F.shuffle("all", seed).alias("all")))
    each = join_small(bucket, base, "bucket").select("base", F.posexplode("all").alias("pos", "x"))
    number = F.col("base") + F.col("pos")
    return each.select("x.record", "x.size", (number % shards).cast("int").alias("shard"),
                       F.floor(number / shards).cast("long").alias("slot"))


def bucket_offsets(rows: DataFrame) -> DataFrame:
    """Records in all earlier buckets, per bucket: sums inside groups of buckets, then over
    the groups, so no task orders more than ``OFFSET_GROUP`` or as many as there are groups."""
    counts = rows.groupBy("bucket").agg(F.count("*").alias("c")).withColumn("g", F.floor(F.col("bucket") / OFFSET_GROUP))
    inside = F.sum("c").over(Window.partitionBy("g").orderBy("bucket")) - F.col("c")
    groups = counts.groupBy("g").agg(F.sum("c").alias("all"))
    earlier = F.sum("all").over(Window.orderBy("g")) - F.col("all")  # a row per 1,024 buckets
    return counts.withColumn("inside", inside).join(groups.select("g", earlier.alias("earlier")), "g").select(
        "bucket", (F.col("inside") + F.col("earlier")).alias("base"))


def write_shards(docs: DataFrame, path: str, size: Column, shards: int = SHARDS, **options) -> None:
    """Write the shuffled records, with ``_slot``, as one folder ``_shard=...`` per shard."""
    placed = shuffle_shards(docs, size, shards, **options)
    (placed.select("record.*", F.col("shard").alias("_shard"), F.col("slot").alias("_slot"))
     .sortWithinPartitions("_shard", "_slot").write.mode("overwrite").option("compression", "zstd").partitionBy("_shard").parquet(path))


def read_shards(spark: SparkSession, path: str, columns: StructType) -> DataFrame:
    """The records that ``write_shards`` wrote, with ``_slot`` and ``_shard``; ``columns``
    are the records' own."""
    schema = StructType([*columns.fields, StructField("_slot", LongType()), StructField("_shard", IntegerType())])
    return spark.read.schema(schema).parquet(path)


def text_size(column: str = "text") -> Column:
    """UTF-8 bytes of a text (null: none), plus one."""
    return F.coalesce(F.octet_length(column), F.lit(0)).cast("long") + 1


@query("op8_sharding")
def op8_sharding(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    path = scratch_dir(spark, "llm", "shards")
    write_shards(docs, path, text_size())
    text = F.coalesce("text", F.lit(""))
    return read_shards(spark, path, docs.schema).select(
        "doc_id", text_size().alias("size"), F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
        F.lit("rows").alias("law"), F.col("_shard").alias("shard"), F.col("_slot").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))
