"""Token totals by source, language and tokenizer version, kept by deltas.

A batch of changes becomes signed deltas (insert +, delete -, revise new - old),
summed per group before they are written, so the state grows with groups and
batches, never with documents. A batch is one partition ``batch=<id>`` of the state
table, written by dynamic partition overwrite, which replaces it as a whole when the
job commits: a batch that is run again, or again after a lost driver, counts once.
Totals are the sum over all committed batches.

Changes have the columns ``kind`` (insert, delete, revise), ``source``, ``lang``,
``tokenizer``, ``tokens`` and, for revise, ``old_tokens``. A document that moves to
another group or tokenizer version is a delete there and an insert here.

Defined results: null source, language or tokenizer are groups of their own; null
tokens count 0; groups whose documents and tokens are both 0 aren't returned; an
empty batch is committed and changes nothing; a batch id committed again replaces
what it held. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyreport.llm.common import table, written
from keyreport.llm.queries import query
from keyreport.session import scratch_dir

GROUP = ["source", "lang", "tokenizer"]
# The words of the two tokenizer versions of the registered query.
WORDS_1 = r"[^\x20\x09-\x0D]+"
WORDS_2 = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def deltas(changes: DataFrame) -> DataFrame:
    """Signed sums of one batch per group."""
    now = F.coalesce(F.col("tokens").cast("long"), F.lit(0))
    old = F.coalesce(F.col("old_tokens").cast("long"), F.lit(0))
    kind = F.col("kind")
    return changes.select(
        *(F.col(c).cast("string").alias(c) for c in GROUP),
        F.when(kind == "insert", 1).when(kind == "delete", -1).otherwise(0).cast("long").alias("documents"),
        F.when(kind == "insert", now).when(kind == "delete", -now).when(kind == "revise", now - old)
        .otherwise(0).alias("tokens"),
    ).groupBy(*GROUP).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))


class TokenRollup:
    """Totals kept under ``path``, a folder all executors share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def commit(self, batch: str, changes: DataFrame) -> None:
        mark = self.spark.range(1).select(
            *(F.lit(None).cast("string").alias(c) for c in GROUP), F.lit(0).cast("long").alias("documents"),
            F.lit(0).cast("long").alias("tokens"), F.lit(True).alias("mark"))
        (deltas(changes).withColumn("mark", F.lit(False)).unionByName(mark).withColumn("batch", F.lit(batch))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(self.path))

    def batches(self) -> DataFrame:
        return self._state().where("mark").select("batch")

    def totals(self) -> DataFrame:
        return (self._state().where("NOT mark").groupBy(*GROUP)
                .agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))
                .where("documents <> 0 OR tokens <> 0"))

    def _state(self) -> DataFrame:
        return self.spark.read.schema(
            "source string, lang string, tokenizer string, documents long, tokens long, mark boolean, batch string"
        ).parquet(self.path)


def matches(pattern: str) -> Column:
    return F.coalesce(F.regexp_count("text", F.lit(pattern)), F.lit(0)).cast("long")


@query("op10_token_rollup", rf"""
WITH d AS (
  SELECT doc_id, source, lang, coalesce(length(regexp_extract_all(text, '{WORDS_1}')), 0) AS w1,
         coalesce(length(regexp_extract_all(text, '{WORDS_2}')), 0) AS w2
  FROM documents
), k AS (
  SELECT d.*, x.doc_id IS NOT NULL AS toxic, y.doc_id IS NOT NULL AS poor
  FROM d LEFT JOIN (SELECT DISTINCT doc_id FROM labels WHERE toxic = 1) x ON d.doc_id = x.doc_id
  LEFT JOIN (SELECT DISTINCT doc_id FROM labels WHERE quality = 0) y ON d.doc_id = y.doc_id
)
SELECT source, lang, CASE WHEN lang = 'en' THEN 'words-2' ELSE 'words-1' END AS tokenizer,
       count(*) AS documents,
       CAST(sum(CASE WHEN lang = 'en' THEN w2 WHEN poor THEN w2 ELSE w1 END) AS BIGINT) AS tokens
FROM k WHERE NOT toxic GROUP BY 1, 2, 3
""")
def op10_token_rollup(spark, sf_dir):
    """Four batches over all documents: load (version words-1); withdraw the toxic
    ones; move English ones to version words-2; revise the counts of poor ones to
    words without punctuation. Two batches are then committed again."""
    rollup = TokenRollup(spark, scratch_dir(spark, "llm", "token-rollup"))
    # The texts are counted once; the batches read a narrow table.
    docs = written(table(spark, sf_dir, "documents").select(
        "doc_id", "source", "lang", matches(WORDS_1).alias("w1"), matches(WORDS_2).alias("w2")), "rollup-counts")
    labels = table(spark, sf_dir, "labels")
    toxic = labels.where("toxic = 1").select("doc_id").distinct()
    poor = labels.where("quality = 0").select("doc_id").distinct()
    no_old = F.lit(None).cast("long").alias("old_tokens")

    def changes(rows: DataFrame, kind: str, tokenizer: str, tokens: str, old: Column = no_old) -> DataFrame:
        return rows.select(F.lit(kind).alias("kind"), "source", "lang", F.lit(tokenizer).alias("tokenizer"),
                           F.col(tokens).alias("tokens"), old)

    clean = docs.join(toxic, "doc_id", "left_anti")
    english, other = clean.where("lang = 'en'"), clean.where("lang IS NULL OR lang <> 'en'")
    batches = {
        "1-load": changes(docs, "insert", "words-1", "w1"),
        "2-withdraw": changes(docs.join(toxic, "doc_id", "left_semi"), "delete", "words-1", "w1"),
        "3-upgrade": changes(english, "delete", "words-1", "w1").union(changes(english, "insert", "words-2", "w2")),
        "4-revise": changes(other.join(poor, "doc_id", "left_semi"), "revise", "words-1", "w2",
                            F.col("w1").alias("old_tokens")),
    }
    for batch, rows in batches.items():
        rollup.commit(batch, rows)
    for batch in ("2-withdraw", "4-revise"):
        rollup.commit(batch, batches[batch])
    return rollup.totals()
