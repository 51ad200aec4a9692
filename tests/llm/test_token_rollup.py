import pytest

from keyreport.llm.catalog import ORACLE_SQL, QUERIES
from keyreport.llm.token_rollup import TokenRollup
from keyreport.session import scratch_dir

from .conftest import SF

SCHEMA = "kind string, source string, lang string, tokenizer string, tokens long, old_tokens long, batch int"


@pytest.fixture()
def rollup(spark):
    return TokenRollup(spark, scratch_dir(spark, "test-rollup"))


def totals(rollup):
    return sorted(tuple(map(str, r)) for r in rollup.totals().collect())


def test_signed_changes_and_commits_again(spark, rollup):
    load = spark.createDataFrame([("insert", "s", "en", "v1", 10, None, 1), ("insert", "s", "en", "v1", None, None, 1),
                                  ("insert", None, None, "v1", 4, None, 1), ("insert", "t", "en", "v1", 3, None, 1)], SCHEMA)
    change = spark.createDataFrame([("revise", "s", "en", "v1", 12, 10, 1), ("delete", "t", "en", "v1", 3, None, 1),
                                    ("insert", "t", "en", "v2", 2, None, 1)], SCHEMA)
    rollup.commit("1", load)
    rollup.commit("2", change)
    want = [("None", "None", "v1", "1", "4"), ("s", "en", "v1", "2", "12"), ("t", "en", "v2", "1", "2")]
    assert totals(rollup) == want
    rollup.commit("1", load)
    rollup.commit("2", change)
    rollup.commit("3", change.limit(0))
    assert totals(rollup) == want
    assert sorted(r["batch"] for r in rollup.batches().collect()) == ["1", "2", "3"]
    rollup.commit("2", change.limit(0))  # replaced as a whole
    assert totals(rollup) == [("None", "None", "v1", "1", "4"), ("s", "en", "v1", "2", "10"), ("t", "en", "v1", "1", "3")]


def test_a_failed_batch_leaves_nothing(spark, rollup):
    from pyspark.sql import functions as F

    load = spark.createDataFrame([("insert", "s", "en", "v1", 10, None, 1)], SCHEMA)
    rollup.commit("1", load)
    with pytest.raises(Exception, match="lost"):
        rollup.commit("2", load.withColumn("tokens", F.raise_error(F.lit("lost")).cast("long")))
    assert totals(rollup) == [("s", "en", "v1", "1", "10")]


def test_query_has_sql(spark):
    assert "op10_token_rollup" in ORACLE_SQL
    assert QUERIES["op10_token_rollup"](spark, SF).count() > 0
