"""The command-line jobs, end to end on fixture files."""

from keyreport import jobs
from keyreport.sources.files import read_lines
from tests.test_reports import CASES, FLIGHTS, RAIN, write


def lines(spark, path):
    return sorted(r[0] for r in read_lines(spark, path).collect())


def test_delay_report_job(spark, tmp_dir):
    src = write(tmp_dir, "f.csv", FLIGHTS)
    jobs.main(["delay-report", "--input", src, "--output", f"{tmp_dir}/out", "--header"], spark)
    assert lines(spark, f"{tmp_dir}/out") == ["BBB;32;2", "CCC;33;1"]


def test_delay_table_job(spark, tmp_dir):
    src = write(tmp_dir, "f.csv", FLIGHTS)
    jobs.main(["delay-table", "--input", src, "--table", "jobs_delays", "--path", f"{tmp_dir}/t"], spark)
    assert sorted(tuple(r) for r in spark.table("jobs_delays").collect()) == [("BBB", 3, 42), ("CCC", 1, 33)]


def test_monthly_report_job(spark, tmp_dir):
    jobs.main(["monthly-report", "--cases", write(tmp_dir, "c.txt", CASES), "--rain", write(tmp_dir, "r.csv", RAIN),
               "--output", f"{tmp_dir}/rep"], spark)
    assert lines(spark, f"{tmp_dir}/rep") == ["AC;2016;03;0.0;0.0", "CE;2015;02;55.0;337.0", "SP;2014;02;4.2;8.0"]


def test_tokens_job(spark, tmp_dir):
    src = write(tmp_dir, "p.txt", "red grün  green\nblue green. green\n")
    jobs.main(["tokens", "--input", src, "--output", f"{tmp_dir}/t", "--words", "green,blue", "--count"], spark)
    assert lines(spark, f"{tmp_dir}/t") == ["blue;1", "green;2"]


def test_publish_then_windowed_stream_job(spark, tmp_dir):
    import json
    import time
    topic = f"{tmp_dir}/topic"
    jobs.main(["publish", "--input", write(tmp_dir, "f.csv", FLIGHTS), "--format", "parquet", "--path", topic], spark)
    time.sleep(2.2)  # the next publish lands two 1-second windows later and moves the watermark past the first
    jobs.main(["publish", "--input", write(tmp_dir, "g.csv", FLIGHTS.splitlines()[0] + "\n"), "--format", "parquet",
               "--path", topic], spark)
    jobs.main(["stream-delay-report", "--source-format", "parquet", "--source-option", f"path={topic}",
               "--source-schema", "value binary, timestamp timestamp", "--window", "1 second",
               "--sink-format", "parquet", "--sink-option", f"path={tmp_dir}/out",
               "--checkpoint", f"{tmp_dir}/ckpt", "--available-now"], spark)
    out = [json.loads(bytes(r[0]).decode()) for r in spark.read.parquet(f"{tmp_dir}/out").collect()]
    assert sorted((o["dest"], o["total_delay"], o["n_delayed"]) for o in out) == [("BBB", 42, 3), ("CCC", 33, 1)]


def test_consume_job_prints_each_batch(spark, tmp_dir, capsys):
    topic = f"{tmp_dir}/topic"
    jobs.main(["publish", "--input", write(tmp_dir, "f.csv", FLIGHTS), "--format", "parquet", "--path", topic], spark)
    jobs.main(["consume", "--source-format", "parquet", "--source-option", f"path={topic}",
               "--source-schema", "value binary, timestamp timestamp", "--checkpoint", f"{tmp_dir}/ckpt",
               "--preview", "2", "--available-now"], spark)
    out = capsys.readouterr().out
    assert "batch 0" in out and "2021-03-01,100," in out
