"""Line deduplication by streamed first occurrences, in DataFrame operations only.

* Every whole text is split at ``\\n``. A line's key is the line without ASCII white
  space at both ends and with A-Z lower-cased; it travels as two 64-bit hashes.
* The hashes are range-partitioned by (key, document) and sorted within by position.
  The ranges are sampled, so a key that a third of all lines share is cut into as many
  ranges as its rows need. In that order the first row of a (key, document) is its first
  occurrence there; no other row goes on. Per key these first occurrences are counted
  and the earliest is kept, combined inside each range before the shuffle.
* Lines of keys found in at least ``min_docs`` documents go: all of them, or with
  ``keep="first"`` all but the earliest by (document, position).
* What comes back is a bitmap per document, not text: 64 lines to a word, and only the
  words in which a line goes, so a document that loses nothing has no row.
  ``apply_bitmaps`` cuts the texts.

Bounded memory: a document's bitmap is a list of at most 1/64 of its lines; no list is
gathered per key. Key rows join the keys that go by ``join_small``: a broadcast under a
measured bound, else a merge join whose skewed partitions are split.

Defined results: a null or empty text is one empty line. A key of fewer than
``min_chars`` code points never goes (an empty key with the default of 1). A document
is an id with its text: rows that repeat both count as one document and share its fate,
rows that repeat an id with another text are other documents. Null ids are kept and come
after all others. An empty table gives no rows. Input columns stay inside the struct
column ``record``, so their names can't clash with the added ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyreport.llm.common import join_small, table, written
from keyreport.llm.queries import query

MIN_DOCS = 10
MIN_CHARS = 1
# ASCII white space, and the letters that are lower-cased.
BLANK = " \t\n\u000b\f\r"
UPPER, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

DOC = ["doc", "t"]
KEY = ["h1", "h2"]


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z lower-cased and no other letter (``lower`` is the same, and
    faster, where every character is one byte)."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, SMALL))


def line_keys(text: Column) -> Column:
    """The keys of all lines of ``text``, in order."""
    return F.transform(F.split(ascii_lower(text), "\n", -1), lambda line: F.btrim(line, F.lit(BLANK)))


def _named(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(2**63 - 1)).alias("doc"),
                       F.xxhash64(text).alias("t"), text.alias("text"), F.struct("*").alias("record"))


def key_rows(docs: DataFrame, min_chars: int, id_col: str, text_col: str) -> DataFrame:
    """One row per line whose key counts: doc, t, pos, h1, h2."""
    lines = _named(docs, id_col, text_col).select(*DOC, F.posexplode(line_keys(F.col("text"))).alias("pos", "key"))
    hashes = [F.xxhash64(F.lit(seed), "key").alias(name) for seed, name in enumerate(KEY)]
    return lines.where(F.char_length("key") >= min_chars).select(*DOC, "pos", *hashes)


def first_occurrences(rows: DataFrame) -> DataFrame:
    """The first row of each key in each document. The window needs no exchange: it
    streams over ranges that are dealt by key and document and sorted by position."""
    ranged = rows.repartitionByRange(*KEY, *DOC).sortWithinPartitions(*KEY, *DOC, "pos")
    nth = F.row_number().over(Window.partitionBy(*KEY, *DOC).orderBy("pos"))
    return ranged.withColumn("nth", nth).where("nth = 1").drop("nth")


def keep_bitmaps(docs: DataFrame, min_docs: int = MIN_DOCS, keep: str = "none", min_chars: int = MIN_CHARS,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc, t, n_dropped, words`` of every document that loses lines: ``doc`` is the id
    (the largest long for a null one), ``t`` the hash of its text, ``words`` the sorted
    (number, bits) of the 64-line words that aren't all kept; a set bit keeps its line."""
    if keep not in ("none", "first"):
        raise ValueError(f"keep must be 'none' or 'first', not {keep!r}")
    rows = written(key_rows(docs, min_chars, id_col, text_col), "lines-keys")
    place = F.struct(*DOC, "pos")
    keys = first_occurrences(rows).groupBy(*KEY).agg(F.count("*").alias("n"), F.min(place).alias("first"))
    often = written(keys.where(F.col("n") >= min_docs).select(*KEY, "first"), "lines-often")
    gone = join_small(rows, often, KEY, row_bytes=64)
    if keep == "first":
        gone = gone.where(place != F.col("first"))
    # Rows that repeat a document set the same bits again.
    bits = gone.groupBy(*DOC, F.floor(F.col("pos") / 64).cast("int").alias("number")).agg(
        F.bit_or(F.expr("shiftleft(1L, pos % 64)")).alias("lost"))
    return bits.groupBy(*DOC).agg(
        F.sum(F.bit_count("lost")).alias("n_dropped"),
        F.sort_array(F.collect_list(F.struct("number", F.bitwise_not("lost").alias("bits")))).alias("words"))


def _dense(words: Column) -> Column:
    """All words up to the last one that isn't all kept, for access by number."""
    before = lambda i: F.when(i == 0, F.lit(-1)).otherwise(F.get(words, i - 1)["number"])
    return F.flatten(F.transform(words, lambda w, i: F.concat(
        F.array_repeat(F.lit(-1).cast("long"), w["number"] - before(i) - 1), F.array(w["bits"]))))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``record, n_lines, n_dropped, kept_text`` per row of ``docs``; ``bitmaps`` is a
    written table of ``keep_bitmaps``. Lines stay as they are, joined by ``\\n``."""
    size = F.size("words") * 16 + 64
    both = join_small(_named(docs, id_col, text_col), bitmaps, DOC, "left", size)
    lines = F.split("text", "\n", -1)

    def kept(state: Column) -> Column:
        # Lambda variables are evaluated once per row, not once per line.
        def stays(_, i):
            word = F.coalesce(F.get(state["dense"], F.floor(i / 64).cast("int")), F.lit(-1).cast("long"))
            return F.getbit(word, i % 64) == 1
        return F.array_join(F.filter(state["lines"], stays), "\n")

    cut = F.get(F.transform(F.array(F.struct(lines.alias("lines"), _dense(F.col("words")).alias("dense"))), kept), 0)
    return both.select("record", F.size(lines).cast("long").alias("n_lines"),
                       F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"),
                       F.when(F.col("words").isNull(), F.col("text")).otherwise(cut).alias("kept_text"))


def line_dedup(docs: DataFrame, min_docs: int = MIN_DOCS, keep: str = "none", min_chars: int = MIN_CHARS,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``record, n_lines, n_dropped, kept_text`` per row of ``docs``; see the module text."""
    bitmaps = written(keep_bitmaps(docs, min_docs, keep, min_chars, id_col, text_col), "lines-bitmaps")
    return apply_bitmaps(docs, bitmaps, id_col, text_col)


_KEY_SQL = (f"translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{SMALL}')")


@query("op11_line_dedup", f"""
WITH lines AS (
  SELECT doc_id, i, line, {_KEY_SQL} AS key FROM (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS i FROM documents)),
often AS (SELECT key FROM lines WHERE length(key) >= {MIN_CHARS} GROUP BY key HAVING COUNT(DISTINCT doc_id) >= {MIN_DOCS})
SELECT doc_id, COUNT(*) AS n_lines, COUNT(o.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE o.key IS NULL), '')) AS kept_sha256
FROM lines LEFT JOIN often o ON lines.key = o.key GROUP BY doc_id
""")
def op11_line_dedup(spark, sf_dir):
    kept = line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("record.doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))
