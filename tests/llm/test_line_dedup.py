import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from keyreport.llm.line_dedup import first_occurrences, keep_bitmaps, key_rows, line_dedup

from .conftest import LOWER

BLANK = " \t\n\x0b\x0c\r"


def keys_of(text):
    return [line.strip(BLANK).translate(LOWER) for line in (text or "").split("\n")]


def brute(rows, min_docs, keep="none", min_chars=1):
    """(id, lines, dropped, kept text's hash) per row; a document is an id and a text."""
    far = 2**63
    docs = {(far if d is None else d, t or "") for d, t in rows}
    found, place = defaultdict(set), {}
    for d, t in docs:
        for i, k in enumerate(keys_of(t)):
            if len(k) >= min_chars:
                found[k].add((d, t))
                if k not in place or (d, i) < place[k][:2]:
                    place[k] = (d, i, t)
    out = []
    for d, t in rows:
        t = t or ""
        kept = []
        for i, (line, k) in enumerate(zip(t.split("\n"), keys_of(t))):
            first = keep == "first" and place.get(k) == (far if d is None else d, i, t)
            if len(found.get(k, ())) < min_docs or first:
                kept.append(line)
        n = t.count("\n") + 1
        out.append((str(d), n, n - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out)


def got(frame):
    out = []
    for r in frame.collect():
        out.append((str(r["record"]["doc_id"]), r["n_lines"], r["n_dropped"],
                    hashlib.sha256(r["kept_text"].encode()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("min_docs,keep,min_chars", [(10, "none", 1), (3, "none", 20), (2, "none", 0)])
def test_equals_brute_force(documents, rows, min_docs, keep, min_chars):
    assert got(line_dedup(documents, min_docs, keep, min_chars)) == brute(rows, min_docs, keep, min_chars)


# Ties between texts of one id are broken by hash in the library, so ids differ here.
LINES = [(d, "\n".join([" Shared LINE \t", f"own {d}", "", "x" * (d % 3), "shared line", "ÀB c", " shared line"]))
         for d in range(40)]
TALL = (100, "\n".join(f"row {i // 2}" if i % 7 else "shared LINE" for i in range(700)))


@pytest.mark.parametrize("min_docs", [1, 2, 30])
@pytest.mark.parametrize("keep", ["none", "first"])
def test_hot_lines_and_long_texts(spark, min_docs, keep):
    data = [*LINES, TALL, (None, "shared line\nafter all"), (200, None), (201, ""), (202, "\n\n")]
    frame = spark.createDataFrame(data, "doc_id long, text string").repartition(6)
    assert got(line_dedup(frame, min_docs, keep)) == brute(data, min_docs, keep)


def test_repeated_rows_are_one_document(spark):
    data = [(1, "same\nother")] * 5 + [(2, "same")]
    frame = spark.createDataFrame(data, "doc_id long, text string")
    assert got(line_dedup(frame, 2)) == brute(data, 2)
    assert {r["n_dropped"] for r in line_dedup(frame, 3).collect()} == {0}
    kept = {(r["record"]["doc_id"], r["kept_text"]) for r in line_dedup(frame, 1, "first").collect()}
    assert kept == {(1, "same\nother"), (2, "")}


def test_first_occurrences_stream_over_one_exchange(spark):
    frame = spark.createDataFrame(LINES, "doc_id long, text string")
    plan = first_occurrences(key_rows(frame, 1, "doc_id", "text"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange rangepartitioning") == 1 and "hashpartitioning" not in plan


def test_a_hot_key_is_cut_into_ranges(spark):
    rows = spark.range(0, 20_000, numPartitions=8).selectExpr(
        "id AS doc_id", "concat('the very common line\nline ', id) AS text")
    ranged = first_occurrences(key_rows(rows, 1, "doc_id", "text")).groupBy(F.spark_partition_id()).count()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert max(r["count"] for r in ranged.collect()) < 40_000 / 4
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_bitmaps_hold_only_words_that_lose_lines(spark):
    text = "\n".join("gone" if i == 130 else f"line {i}" for i in range(1000))
    frame = spark.createDataFrame([(1, text), (2, "gone"), (3, "stays")], "doc_id long, text string")
    maps = {r["doc"]: r for r in keep_bitmaps(frame, 2).collect()}
    assert set(maps) == {1, 2}
    assert [(w["number"], w["bits"]) for w in maps[1]["words"]] == [(2, ~(1 << 2))] and maps[1]["n_dropped"] == 1


def test_unknown_rule_is_refused(spark):
    with pytest.raises(ValueError):
        keep_bitmaps(spark.createDataFrame(LINES, "doc_id long, text string"), keep="last")


def test_empty_table(nothing):
    assert got(line_dedup(nothing)) == []
