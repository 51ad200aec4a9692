"""Fill-in-the-middle transformation by repeated-capture matching.

One possessive ``fullmatch`` of ``(unit)*`` of the ``regex`` library keeps every
repetition of its group: ``match.ends(1)`` is the list of all units' ends, so its length
is n and two look-ups give both cut offsets. The task returns these three numbers per
text, in Arrow batches; the record and its text stay in the JVM, where the parts are cut
and joined.

The cuts and the form come from a seeded hash of the id alone: h1 to h4 are the first
four 8-digit groups of the hex sha256 of ``<seed>:<id>``. The prefix ends after the
smaller of h1 % (n + 1) and h2 % (n + 1) units, the middle after the larger.

* ``psm``: ``<P>prefix<S>suffix<M>middle``
* ``spm``: ``<S>suffix<P>prefix<M>middle``, for ``spm`` of 100 values of h4 % 100
* ``plain``: the text as it is, if it is empty, holds a marker, or h3 % 100 >= ``rate``

``restore`` rebuilds the text from output and form: a text that is cut holds no marker,
and no marker starts with another one's end, so the markers that were set are found.

The default unit is a line with its end. Another unit must match whole texts when
repeated; a text that it doesn't match has no units and stays plain.

Defined results: a null text is empty (n 0, plain, empty output). A null id hashes as an
empty one. Rows that repeat an id or all columns are cut each, equal rows equally. An
empty table gives no rows. A text is matched as a whole; a task holds the texts of one
Arrow batch (``spark.sql.execution.arrow.maxBytesPerBatch``, or one row) and the ends of one text.
Input columns stay inside the struct column ``record``.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyreport.llm.common import table
from keyreport.llm.queries import query

# The markers, and the unit of the registered query.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
LINE_UNIT = r"[^\n]*\n|[^\n]+"
SEED = "7"
RATE, SPM = 100, 50


def hash_groups(id_column: Column, seed: str = SEED) -> list[Column]:
    """The four hash numbers of a row."""
    sha = F.sha2(F.concat(F.lit(seed + ":"), F.coalesce(id_column.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(sha, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def cut_offsets(unit: str):
    """An Arrow function (text, h1, h2) -> struct of n, first and second cut; n is null
    where the units don't make up the text."""
    @F.arrow_udf("struct<n: long, first: long, second: long>")
    def cuts(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        repeated = regex.compile(rf"({unit})*+")
        for texts, h1, h2 in batches:
            out = []
            for text, a, b in zip(texts, h1.to_pylist(), h2.to_pylist(), strict=True):
                match = repeated.fullmatch(text.as_py())
                if match is None:
                    out.append({"n": None, "first": 0, "second": 0})
                    continue
                ends = [0, *match.ends(1)]
                a, b = a % len(ends), b % len(ends)
                out.append({"n": len(ends) - 1, "first": ends[min(a, b)], "second": ends[max(a, b)]})
            yield pa.array(out, pa.struct([("n", pa.int64()), ("first", pa.int64()), ("second", pa.int64())]))

    return cuts


def fill_in_middle(docs: DataFrame, unit: str = LINE_UNIT, seed: str = SEED, rate: int = RATE, spm: int = SPM,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``record, n, form, prefix_chars, middle_chars, output`` per row of ``docs``."""
    h1, h2, h3, h4 = hash_groups(F.col(id_col), seed)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.struct("*").alias("record"), text.alias("text"), h1.alias("h1"), h2.alias("h2"),
                       (h3 % 100).alias("h3"), (h4 % 100).alias("h4"))
    rows = rows.withColumn("cut", cut_offsets(unit)("text", "h1", "h2"))
    first, second = F.col("cut.first"), F.col("cut.second")
    text = F.col("text")
    plain = (F.length(text) == 0) | (F.col("h3") >= rate) | F.col("cut.n").isNull()
    for marker in (PREFIX, SUFFIX, MIDDLE):
        plain = plain | F.contains(text, F.lit(marker))
    prefix, middle = F.substring(text, F.lit(1), first), F.substring(text, first + 1, second - first)
    suffix = F.substring(text, second + 1, F.length(text))
    form = F.when(plain, "plain").when(F.col("h4") < spm, "spm").otherwise("psm")
    rows = rows.withColumn("form", form)
    output = (F.when(F.col("form") == "plain", text)
              .when(F.col("form") == "psm", F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle))
              .otherwise(F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle)))
    whole = F.col("form") == "plain"
    return rows.select("record", F.coalesce("cut.n", F.lit(0)).cast("long").alias("n"), "form",
                       F.when(~whole, first).alias("prefix_chars"), F.when(~whole, second - first).alias("middle_chars"),
                       output.alias("output"))


def restore(output: Column, form: Column) -> Column:
    """The text from its transformed form."""
    def between(start: str, end: str | None) -> Column:
        begin = F.instr(output, start) + len(start)
        return F.substring(output, begin, (F.instr(output, end) - begin) if end else F.length(output))

    psm = F.concat(between(PREFIX, SUFFIX), between(MIDDLE, None), between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), between(MIDDLE, None), between(SUFFIX, PREFIX))
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)


_UNSIGNED = "CAST('0x' || substr(sha256('7:' || CAST(doc_id AS VARCHAR)), {}, 8) AS BIGINT)"


@query("op12_fill_in_middle", f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10)) AS lines,
         {", ".join(f"{_UNSIGNED.format(8 * k + 1)} AS h{k + 1}" for k in range(4))}
  FROM documents),
u AS (SELECT *, len(lines) - (CASE WHEN lines[-1] = '' THEN 1 ELSE 0 END) AS n FROM d),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b FROM u),
o AS (SELECT *, CASE WHEN a = len(lines) THEN length(text) WHEN a = 0 THEN 0
                     ELSE length(array_to_string(lines[1:a], chr(10))) + 1 END AS p,
             CASE WHEN b = len(lines) THEN length(text) WHEN b = 0 THEN 0
                  ELSE length(array_to_string(lines[1:b], chr(10))) + 1 END AS q,
             CASE WHEN text = '' OR contains(text, '{PREFIX}') OR contains(text, '{SUFFIX}') OR contains(text, '{MIDDLE}')
                       OR h3 % 100 >= {RATE} THEN 'plain' WHEN h4 % 100 < {SPM} THEN 'spm' ELSE 'psm' END AS form FROM c),
f AS (SELECT *, substr(text, 1, p) AS pre, substr(text, p + 1, q - p) AS mid, substr(text, q + 1) AS suf FROM o)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN p END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN q - p END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '{PREFIX}' || pre || '{SUFFIX}' || suf || '{MIDDLE}' || mid
                   ELSE '{SUFFIX}' || suf || '{PREFIX}' || pre || '{MIDDLE}' || mid END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM f
""")
def op12_fill_in_middle(spark, sf_dir):
    out = fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("record.doc_id", "n", "form", "prefix_chars", "middle_chars",
                      F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"))
