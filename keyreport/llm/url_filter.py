"""URL allow and block rules by a trie of reversed host labels and path segments.

A rule is a host and a path. It fits the host itself and all its subdomains, if the
URL's path starts with the rule's. Of several, the one with most host labels wins,
then the longest path; of an allow and a block rule for the same host and path the
block rule. Without a rule the verdict is ``default``.

The trie's first levels are host labels from the right; below each host its paths
follow by whole segments, the last segment may be a prefix. It is sent to the tasks
only if the rules hold at most ``TRIE_BYTES``; more rules are joined on host suffix
instead, with the same verdicts. URLs aren't shuffled for the trie.

Defined results: a null URL, or one without ``://``, has empty host and path and
gets the default. Host: from there up to ``/``, ``?``, ``#`` or the end, A-Z
lower-cased; path: from there up to ``?``, ``#`` or the end. A rule without host or
verdict says nothing and is left out; one without a path fits every path. Repeated rows
are judged each. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyreport.llm.common import table
from keyreport.llm.queries import query

# The rules of the registered query (verdict, host, path).
RULES = [
    ("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"), ("block", "net", "/fr/"),
]
TRIE_BYTES = 16 << 20
PATHS = "/"  # key of a host node's path trie; no host label holds a slash

VERDICT = "rule string, verdict string"


def url_host(url: Column) -> Column:
    host = F.regexp_extract(_behind_scheme(url), "^[^/?#]*", 0)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_path(url: Column) -> Column:
    return F.regexp_extract(_behind_scheme(url), "^[^/?#]*([^?#]*)", 1)


def _behind_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))


def build_trie(rules: Iterable[tuple[str, str, str]]) -> dict:
    root: dict = {}
    for verdict, host, path in rules:
        node = root
        for label in reversed(host.split(".")):
            node = node.setdefault(label, {})
        *whole, last = path.split("/")
        place = node.setdefault(PATHS, ({}, {}))
        for segment in whole:
            place = place[0].setdefault(segment, ({}, {}))
        if place[1].get(last, ("", "allow"))[1] != "block":
            place[1][last] = (host + path, verdict)
    return root


def lookup(root: dict, host: str, path: str) -> tuple[str, str] | None:
    """(rule, verdict) of the longest fitting rule."""
    node, found = root, None
    segments = path.split("/")
    for label in reversed(host.split(".")):
        node = node.get(label)
        if node is None:
            break
        place, best = node.get(PATHS), None
        depth = 0
        while place is not None:
            fits = [p for p in place[1] if segments[depth].startswith(p)]
            if fits:
                best = place[1][max(fits, key=len)]
            # A segment is whole if a slash follows it.
            place = place[0].get(segments[depth]) if depth + 1 < len(segments) else None
            depth += 1
        found = best or found
    return found


def filter_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", id_col: str = "page_id",
                url_col: str = "url") -> DataFrame:
    """One row per page: id, host, path, rule, verdict. ``rules(verdict, host, path)``."""
    rules = rules.where("host IS NOT NULL AND verdict IS NOT NULL").select(
        "verdict", "host", F.coalesce("path", F.lit("")).alias("path"))
    url = F.col(url_col).cast("string")
    parts = pages.select(F.col(id_col), url_host(url).alias("host"), url_path(url).alias("path"))
    size = rules.agg(F.coalesce(F.sum(F.octet_length("host") + F.octet_length("path") + 64), F.lit(0)).alias("b"))
    if size.first()["b"] <= TRIE_BYTES:
        return by_trie(parts, [(r["verdict"], r["host"], r["path"]) for r in rules.collect()], default, id_col)
    return by_join(parts, rules, default, id_col)


def by_trie(parts: DataFrame, rules: list[tuple[str, str, str]], default: str, id_col: str) -> DataFrame:
    sent = parts.sparkSession.sparkContext.broadcast(build_trie(rules))

    @F.pandas_udf(VERDICT)
    def judge(host: pd.Series, path: pd.Series) -> pd.DataFrame:
        trie = sent.value
        found = [lookup(trie, h, p) or (None, default) for h, p in zip(host, path, strict=True)]
        return pd.DataFrame(found, columns=["rule", "verdict"])

    return parts.withColumn("v", judge("host", "path")).select(id_col, "host", "path", "v.rule", "v.verdict")


def by_join(parts: DataFrame, rules: DataFrame, default: str, id_col: str) -> DataFrame:
    """The same verdicts by joining each host's suffixes; each distinct host and path
    is judged once."""
    urls = parts.select("host", "path").distinct()
    labels = F.split("host", "[.]", -1)
    suffix = F.explode(F.transform(F.sequence(F.lit(1), F.size(labels)),
                                   lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")))
    r = rules.select(F.col("host").alias("rule_host"), F.col("path").alias("rule_path"), "verdict")
    fits = (urls.select("host", "path", suffix.alias("rule_host")).join(r, "rule_host")
            .where(F.startswith("path", "rule_path")))
    rank = F.struct(F.size(F.split("rule_host", "[.]", -1)).alias("labels"), F.length("rule_path").alias("length"),
                    (F.col("verdict") == "block").alias("block"),
                    F.concat("rule_host", "rule_path").alias("rule"), "verdict")
    best = fits.groupBy("host", "path").agg(F.max(rank).alias("v"))
    return parts.join(best, ["host", "path"], "left").select(
        id_col, "host", "path", "v.rule", F.coalesce("v.verdict", F.lit(default)).alias("verdict"))


@query("op9_url_filter", r"""
WITH p AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), q AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM (SELECT page_id, coalesce(rest, '') AS rest FROM p)
), r AS (
  SELECT *, CASE
    WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/' END AS rule
  FROM q
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END AS verdict
FROM r
""")
def op9_url_filter(spark, sf_dir):
    rules = spark.createDataFrame(RULES, "verdict string, host string, path string")
    return filter_urls(table(spark, sf_dir, "pages"), rules)
