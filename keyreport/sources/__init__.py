"""Readers: in-memory rows, text lines, delimited files, parquet tables and
message streams. Paths may be any Hadoop filesystem URI (local, HDFS, object
stores) — the readers do not care."""

from keyreport.sources.files import *  # noqa: F401,F403
from keyreport.sources.streams import *  # noqa: F401,F403
