"""Command-line jobs for the reports, for ``spark-submit`` or ``python -m``.

    python -m keyreport.jobs delay-report  --input flights/ --header --output out/
    python -m keyreport.jobs delay-table   --input flights/ --header --table db.delays [--path p]
    python -m keyreport.jobs monthly-report --cases cases/ --rain rain/ --output report/
    python -m keyreport.jobs tokens        --input text/ --output counts/ [--words blue,green]
    python -m keyreport.jobs stream-delay-report --source-format kafka \\
        --source-option kafka.bootstrap.servers=h:9092 --source-option subscribe=flights \\
        --window "5 seconds" [--period "5 seconds"] --sink-format kafka \\
        --sink-option kafka.bootstrap.servers=h:9092 --sink-option topic=out --checkpoint ckpt/
    python -m keyreport.jobs publish --input flights/ --format kafka --option ... (each line → a message)
    python -m keyreport.jobs consume --source-format kafka --source-option ... --checkpoint ckpt/

Paths may be any Hadoop filesystem URI. The session comes from spark-submit
(or a local one when run with python); checkpoints go where ``--checkpoint``
says, which on a cluster must be shared storage.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from keyreport.functions.predicates import in_set
from keyreport.functions.shaping import explode_tokens, join_fields
from keyreport.operators.keyed import count_per_element
from keyreport.plans import reports as R
from keyreport.session import build_session
from keyreport.sinks.files import append_table, write_lines
from keyreport.sinks.streams import preview_batches, publish_table, write_messages
from keyreport.sources.files import read_lines
from keyreport.sources.streams import read_messages


def _options(pairs: list[str] | None) -> dict[str, str]:
    out = {}
    for p in pairs or []:
        k, _, v = p.partition("=")
        out[k] = v
    return out


def delay_report(spark: SparkSession, a: argparse.Namespace) -> None:
    rep = R.flight_delay_report(R.read_flights(spark, a.input, header=a.header, strict=not a.tolerant))
    write_lines(rep, a.output, join_fields(rep.columns, a.sep))


def delay_table(spark: SparkSession, a: argparse.Namespace) -> None:
    rows = R.flight_delay_table(R.read_flights(spark, a.input, header=a.header, strict=not a.tolerant))
    append_table(rows, a.table, R.DELAY_TABLE_SCHEMA, path=a.path)


def monthly_report(spark: SparkSession, a: argparse.Namespace) -> None:
    rep = R.monthly_report(R.read_cases(spark, a.cases), R.read_rain(spark, a.rain))
    write_lines(rep, a.output, "line")


def tokens(spark: SparkSession, a: argparse.Namespace) -> None:
    toks = explode_tokens(read_lines(spark, a.input), "value")
    if a.words:
        toks = toks.where(in_set("token", a.words.split(",")))
    if a.count:
        counts = count_per_element(toks, ["token"])
        write_lines(counts, a.output, join_fields(["token", "n"], a.sep))
    else:
        write_lines(toks, a.output, "token")


def stream_delay_report(spark: SparkSession, a: argparse.Namespace) -> None:
    msgs = read_messages(spark, a.source_format, a.source_schema, **_options(a.source_option))
    rep = R.windowed_delay_report(msgs, a.window, a.period, a.lateness)
    q = write_messages(rep, a.checkpoint, a.sink_format, available_now=a.available_now,
                       **_options(a.sink_option))
    q.awaitTermination()


def publish(spark: SparkSession, a: argparse.Namespace) -> None:
    """Each line as a message (with its newline, as a file's lines are sent).
    A broker stamps the publish time itself; for a file format the write time
    is stored in ``timestamp``."""
    lines = read_lines(spark, a.input).select(F.encode(F.concat("value", F.lit("\n")), "UTF-8").alias("value"))
    if a.format != "kafka":
        lines = lines.withColumn("timestamp", F.current_timestamp())
    publish_table(lines, a.format, a.path, **_options(a.option))


def consume(spark: SparkSession, a: argparse.Namespace) -> None:
    msgs = read_messages(spark, a.source_format, a.source_schema, **_options(a.source_option))
    preview_batches(msgs.select(F.decode("value", "UTF-8").alias("message"), "ts"), a.checkpoint, a.preview,
                    available_now=a.available_now).awaitTermination()


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="keyreport.jobs", description=__doc__.split("\n")[0])
    sub = p.add_subparsers(dest="job", required=True)

    s = sub.add_parser("delay-report", help="delayed flights per destination: total and count")
    s.add_argument("--input", required=True)
    s.add_argument("--output", required=True)
    s.add_argument("--header", action="store_true", help="skip the first line of each file")
    s.add_argument("--tolerant", action="store_true", help="bad numbers read as NULL instead of failing")
    s.add_argument("--sep", default=";")
    s.set_defaults(run=delay_report)

    s = sub.add_parser("delay-table", help="the delay report appended to a table with a declared schema")
    s.add_argument("--input", required=True)
    s.add_argument("--table", required=True)
    s.add_argument("--path", help="external table location")
    s.add_argument("--header", action="store_true")
    s.add_argument("--tolerant", action="store_true")
    s.set_defaults(run=delay_table)

    s = sub.add_parser("monthly-report", help="cases and rain per state and month, matched")
    s.add_argument("--cases", required=True)
    s.add_argument("--rain", required=True)
    s.add_argument("--output", required=True)
    s.set_defaults(run=monthly_report)

    s = sub.add_parser("tokens", help="whitespace tokens of text files, optionally filtered and counted")
    s.add_argument("--input", required=True)
    s.add_argument("--output", required=True)
    s.add_argument("--words", help="comma-separated words to keep")
    s.add_argument("--count", action="store_true")
    s.add_argument("--sep", default=";")
    s.set_defaults(run=tokens)

    s = sub.add_parser("stream-delay-report", help="windowed delay report from a message stream")
    s.add_argument("--source-format", default="kafka")
    s.add_argument("--source-option", action="append")
    s.add_argument("--source-schema", help="for a file format, e.g. 'value binary, timestamp timestamp'")
    s.add_argument("--window", required=True)
    s.add_argument("--period")
    s.add_argument("--lateness", default="0 seconds")
    s.add_argument("--sink-format", default="kafka")
    s.add_argument("--sink-option", action="append")
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--available-now", action="store_true", help="process what is there, then stop")
    s.set_defaults(run=stream_delay_report)

    s = sub.add_parser("publish", help="every line of text files as a message")
    s.add_argument("--input", required=True)
    s.add_argument("--format", default="kafka")
    s.add_argument("--path", help="for a file format: the folder a file stream reads")
    s.add_argument("--option", action="append")
    s.set_defaults(run=publish)

    s = sub.add_parser("consume", help="print a preview of each micro-batch of messages")
    s.add_argument("--source-format", default="kafka")
    s.add_argument("--source-option", action="append")
    s.add_argument("--source-schema")
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--preview", type=int, default=20)
    s.add_argument("--available-now", action="store_true")
    s.set_defaults(run=consume)
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    spark = spark or SparkSession.getActiveSession() or build_session(app=f"keyreport-{args.job}")
    args.run(spark, args)


if __name__ == "__main__":
    main(sys.argv[1:])
