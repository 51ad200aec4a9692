import zlib

import pytest
from pyspark.sql import functions as F

from keyreport.llm import sharding
from keyreport.llm.catalog import QUERIES
from keyreport.llm.sharding import read_shards, shuffle_shards, text_size, write_shards

from .conftest import SF


@pytest.mark.parametrize("bucket_bytes", [64 << 20, 5000])
def test_every_row_has_one_place(documents, rows, bucket_bytes):
    out = shuffle_shards(documents, text_size(), shards=7, bucket_bytes=bucket_bytes).collect()
    assert sorted((str(r["record"]["doc_id"]), str(r["record"]["text"])) for r in out) == sorted((str(d), str(t)) for d, t in rows)
    places = {}
    for r in out:
        places.setdefault(r["shard"], []).append(r["slot"])
        assert r["size"] == len((r["record"]["text"] or "").encode()) + 1
    assert all(sorted(s) == list(range(len(s))) for s in places.values())
    assert max(map(len, places.values())) - min(map(len, places.values())) <= 1


def test_order_is_shuffled_and_repeatable(spark):
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    once = [(r["shard"], r["slot"], r["record"]["doc_id"]) for r in shuffle_shards(docs, text_size(), 4).collect()]
    again = [(r["shard"], r["slot"], r["record"]["doc_id"]) for r in shuffle_shards(docs, text_size(), 4).collect()]
    assert sorted(once) == sorted(again)
    order = [d for _, d in sorted((slot * 4 + shard, d) for shard, slot, d in once)]
    rising = sum(a < b for a, b in zip(order[:-1], order[1:], strict=True))
    assert 0.45 < rising / len(order) < 0.55
    halves = [sum(d < 2500 for s, _, d in once if s == k) for k in range(4)]
    assert all(500 < h < 750 for h in halves)


def test_written_shards_hold_all_rows(spark, documents, tmp_dir):
    write_shards(documents.select("doc_id", "text", "shard"), tmp_dir + "/out", text_size(), 4)
    back = spark.read.parquet(tmp_dir + "/out")
    assert back.count() == documents.count() and back.select("_shard").distinct().count() == 4


def test_shards_are_written_in_slot_order_without_a_second_shuffle(spark, tmp_dir):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), (F.col("id") % 90).cast("int")).alias("text"))
    write_shards(docs, tmp_dir + "/out", text_size(), 3, bucket_bytes=20_000)
    back = read_shards(spark, tmp_dir + "/out", docs.schema).withColumn("file", F.input_file_name()).collect()
    files, slots = {}, {}
    for r in back:
        files.setdefault(r["file"], []).append(r["_slot"])
        slots.setdefault(r["_shard"], []).append(r["_slot"])
    assert len(files) >= 6 and all(s == sorted(s) for s in files.values())
    assert all(sorted(s) == list(range(1000)) for s in slots.values())
    again = shuffle_shards(docs, text_size(), 3, bucket_bytes=20_000).collect()
    assert {(r["record"]["doc_id"], r["shard"], r["slot"]) for r in again} == {(r["doc_id"], r["_shard"], r["_slot"]) for r in back}


def test_offsets_of_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(sharding, "OFFSET_GROUP", 4)
    rows = spark.createDataFrame([(b,) for b in range(0, 60, 2) for _ in range(b % 7 + 1)], "bucket long")
    got = {r["bucket"]: r["base"] for r in sharding.bucket_offsets(rows).collect()}
    want, total = {}, 0
    for b in range(0, 60, 2):
        want[b], total = total, total + b % 7 + 1
    assert got == want


def test_query(spark):
    out = QUERIES["op8_sharding"](spark, SF).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(out) == len(texts)
    for r in out:
        assert r["text_crc32"] == zlib.crc32(texts[r["doc_id"]].encode()) and r["law"] == "rows" and r["grown_shard"] is None


def test_empty_table(nothing):
    assert shuffle_shards(nothing, text_size()).count() == 0
