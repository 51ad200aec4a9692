"""Registered queries: lines below headers, records by names in the data, long lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyreport.functions.predicates import in_large_set
from keyreport.functions.shaping import WHITESPACE_CLASS, explode_tokens, map_columns, map_names
from keyreport.operators.keyed import count_per_element
from keyreport.plans.catalog import query, t
from keyreport.session import scratch_dir
from keyreport.sinks.files import write_delimited
from keyreport.sources.files import read_records, read_text_lines


@query("verbatim_lines", """
SELECT line, COUNT(*) AS n FROM (
  SELECT CASE WHEN o_orderkey % 5 = 0 THEN '' WHEN o_orderkey % 5 = 1 THEN chr(1) || o_custkey
              WHEN o_orderkey % 5 = 2 THEN 'header' ELSE '"' || o_orderstatus || ' | ' END AS line FROM orders) GROUP BY line
""")
def q_verbatim_lines(spark: SparkSession, sf: str) -> DataFrame:
    """S3: the header of each of many files goes, and no other line: blank lines, lines
    equal to the header, quotes and control characters stay."""
    o = t(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderstatus")
    kind = F.col("o_orderkey") % 5
    line = F.when(kind == 0, "").when(kind == 1, F.concat(F.lit("\u0001"), F.col("o_custkey").cast("string"))) \
        .when(kind == 2, "header").otherwise(F.concat(F.lit('"'), "o_orderstatus", F.lit(" | ")))
    rows = o.select((F.col("o_orderkey") % 24).cast("int").alias("file"), F.lit(1).alias("place"), line.alias("value"))
    heads = spark.range(24).select(F.col("id").cast("int"), F.lit(0), F.lit("header"))
    path = scratch_dir(spark, "files", "verbatim")
    # One file per folder, its header first.
    (rows.union(heads).repartition("file").sortWithinPartitions("file", "place").select("file", "value")
     .write.partitionBy("file").text(path))
    return count_per_element(read_text_lines(spark, path, header=True).select(F.col("value").alias("line")))




def _party_records(spark: SparkSession, sf: str) -> DataFrame:
    """Customers and suppliers as text files with headers of their own."""
    path = scratch_dir(spark, "files", "records")
    for name, columns in (("customer", ["c_name", "c_nationkey", "c_custkey"]), ("supplier", ["s_suppkey", "s_name"])):
        write_delimited(t(spark, sf, name, *columns), f"{path}/{name}", sep="|", header=True)
    return read_records(spark, [f"{path}/customer", f"{path}/supplier"], "|").select("record")


@query("records_by_header", """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey, '' AS s_name, '' AS s_suppkey
FROM customer
UNION ALL SELECT '', '', '', s_name, CAST(s_suppkey AS VARCHAR) FROM supplier
""")
def q_records_by_header(spark: SparkSession, sf: str) -> DataFrame:
    """``dict(zip())`` with names from each file's header line, then a column per name
    found in the data."""
    return map_columns(_party_records(spark, sf), "record").na.fill("")


@query("record_names", """
SELECT unnest(['c_custkey', 'c_name', 'c_nationkey']) AS name, (SELECT COUNT(*) FROM customer) AS n
UNION ALL SELECT unnest(['s_name', 's_suppkey']), (SELECT COUNT(*) FROM supplier)
""")
def q_record_names(spark: SparkSession, sf: str) -> DataFrame:
    """The names that records of several files have."""
    return map_names(_party_records(spark, sf), "record")


@query("token_in_table", f"""
WITH words AS (SELECT DISTINCT unnest(regexp_split_to_array(text, '{WHITESPACE_CLASS}+')) AS word FROM benchmark),
tokens AS (SELECT unnest(regexp_split_to_array(text, '{WHITESPACE_CLASS}+')) AS token FROM documents)
SELECT token, COUNT(*) AS n FROM tokens WHERE token <> '' AND token IN (SELECT word FROM words) GROUP BY token
""")
def q_token_in_table(spark: SparkSession, sf: str) -> DataFrame:
    """P2 + F2 with a list of any length: tokens that are words of the benchmark items,
    through a Bloom filter and an exact semi-join."""
    words = explode_tokens(t(spark, sf, "benchmark", "text"), "text", "word")
    return count_per_element(in_large_set(explode_tokens(t(spark, sf, "documents", "text"), "text"), "token", words), ["token"])


@query("orders_in_table", """
SELECT l_returnflag, COUNT(*) AS n FROM lineitem
WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P') GROUP BY l_returnflag
""")
def q_orders_in_table(spark: SparkSession, sf: str) -> DataFrame:
    """lines of orders in a list of keys; lines of other orders go where they are read."""
    keys = t(spark, sf, "orders", "o_orderkey", "o_orderstatus").where("o_orderstatus = 'P'").select("o_orderkey")
    lines = in_large_set(t(spark, sf, "lineitem", "l_orderkey", "l_returnflag"), "l_orderkey", keys)
    return count_per_element(lines, ["l_returnflag"])
