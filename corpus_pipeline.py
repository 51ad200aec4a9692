"""Corpus pipeline: five stages from raw documents to packed sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it
as a table in the shared folder and reads it back as the next stage's docs. All but
the last return the columns of ``documents``.

1. ``language``: rows whose text has no letter, or whose calibrated language
   probability is below ``MIN_LANGUAGE_SCORE``, go. If no row that may be learned
   from has a lang, nothing is known of languages and all texts with a letter stay.
2. ``near_duplicates``: of each group linked by five-word shingles at a Jaccard
   similarity of at least 0.8, the row with the smallest doc_id (null ids last)
   stays. Texts without words are linked with nothing and stay.
3. ``substrings``: words covered by a repeated 20-word window that also starts
   earlier (by doc_id, null ids last, and place) go from the text; a text that
   loses nothing is unchanged; a row that loses all its words goes.
4. ``decontamination``: rows that hold a benchmark item go.
5. ``packing``: the rest, tokenised and packed into sequences of 1024: a row per piece
   with its ids and its place.

Stages 2 and 3 give each of their rows a key of its own and judge rows
by it, stage 4 by a 64-bit hash of the text: rows with a null or repeated doc_id are
judged each by its own text. The key is the row's file and place in it, so no copy of the
rows is written; rows that are not read from files one by one get a key with a copy. Rows that
share an id are ordered by that key. Tables that no stage reads any more are removed. An empty table stays empty. Extra columns are carried
along up to the last stage.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyreport.llm.common import drop, join_small, table, tidy, written
from keyreport.llm.decontaminate import decontaminate
from keyreport.llm.language_id import UNKNOWN, fit, predict
from keyreport.llm.ngram_jaccard import ngram_jaccard
from keyreport.llm.packing import pack
from keyreport.llm.substring_dedup import substring_dedup

MIN_LANGUAGE_SCORE = 0.5
SHINGLE_WORDS = 5
SIMILARITY = (80, 100)
PASSAGE_WORDS = 20
# Bits of a row's number in its file.
FILE_ROWS = 40


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = fit(docs)
    if not model.labels:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = predict(docs, model)
    sure = (F.col("lang_pred") != UNKNOWN) & (F.col("score") >= MIN_LANGUAGE_SCORE)
    return found.where(sure).select("record.*")


def key_name(docs: DataFrame) -> str:
    taken = {c.lower() for c in docs.columns}
    key = "row_key"
    while key in taken:
        key += "_"
    return key


def keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a unique number per row, and that column's name: the row's file and
    place where they tell rows apart, else a number written with a copy of the rows."""
    key = key_name(docs)
    placed = in_files(docs, key)
    if placed is not None and placed.groupBy(key).count().where(F.col(key).isNull() | (F.col("count") > 1)).isEmpty():
        return placed, key
    return written(docs.withColumn(key, F.monotonically_increasing_id()), "pipeline-rows", "zstd"), key


def in_files(docs: DataFrame, key: str) -> DataFrame | None:
    """``docs`` with file number and row number as ``key``; None if its source has none."""
    path, row = f"{key}_file", f"{key}_row"
    try:
        at = docs.metadataColumn("_metadata")
        rows = docs.select("*", at.getField("file_path").alias(path), at.getField("row_index").alias(row))
    except AnalysisException:
        return None
    paths = sorted(r[0] for r in rows.select(path).distinct().collect())  # one per file
    files = docs.sparkSession.createDataFrame([(p, i << FILE_ROWS) for i, p in enumerate(paths)], f"{path} string, {key} long")
    rows = rows.join(F.broadcast(files), path, "left")
    return rows.select(*(F.col(f"`{c}`") for c in docs.columns), (F.col(key) + F.col(row)).alias(key))


def without(rows: DataFrame, gone: DataFrame, key: str, columns: list[str]) -> DataFrame:
    return join_small(rows, gone, key, "left_anti").select(*(F.col(f"`{c}`") for c in columns))


@tidy
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    num, den = SIMILARITY
    rows, key = keyed(docs)
    classes = ngram_jaccard(rows, n=SHINGLE_WORDS, num=num, den=den, id_col=key)
    linked = written(classes.where("component_id <> doc_id")
                     .select(F.col("doc_id").alias(key), F.col("component_id").alias("root")), "pipeline-linked")
    roots = linked.select(F.col("root").alias(key), "root").distinct()
    members = written(linked.union(roots), "pipeline-members")
    ids = rows.select(key, F.col("doc_id").alias("id"))
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", key)).alias("first")
    stay = join_small(ids, members, key).groupBy("root").agg(first).select(F.col(f"first.{key}").alias(key))
    gone = join_small(members.select(key), written(stay, "pipeline-stay"), key, "left_anti")
    return without(rows, written(gone, "pipeline-near"), key, docs.columns)


@tidy
def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows, key = keyed(docs)
    kept = substring_dedup(rows, width=PASSAGE_WORDS, joined=False, row_col=key)
    changed = F.col("n_removed") > 0
    new = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    return kept.where("n_removed < n_words OR n_words = 0").select(*(
        F.when(changed, new[c]).otherwise(F.col(f"record.`{c}`")).alias(c) if c in new else F.col(f"record.`{c}`")
        for c in docs.columns))


@tidy
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # What a row holds depends on its text alone: its hash is the key, and no copy of the rows is written.
    key = key_name(docs)
    rows = docs.withColumn(key, F.xxhash64("text"))
    found = decontaminate(rows, table(spark, sf_dir, "benchmark"), id_col=key)
    gone = found.select(F.col("doc_id").alias(key)).distinct()
    return without(rows, written(gone, "pipeline-leaks"), key, docs.columns)


@tidy
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, with_ids=True)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("substrings", substrings),
    ("decontamination", decontamination),
    ("packing", packing),
]

# A trained classifier, an iterated component search and a tokenizer: not SQL.
ORACLE_SQL = None


@tidy
def finished(name: str, spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return written(dict(STAGES)[name](spark, docs, sf_dir), f"pipeline-{name}")


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, _) in enumerate(STAGES):
        done = finished(name, spark, docs, sf_dir)
        if k:
            drop(docs)  # the table of the stage before
        docs = done
    return docs
