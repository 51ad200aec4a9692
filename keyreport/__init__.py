"""keyreport: keyed aggregation, co-grouping and windowing on Spark DataFrames.

Every operation is a function from DataFrame(s) to DataFrame built on Column
expressions, so Catalyst can push filters, prune columns and fuse the work into
whole-stage codegen. The same row and aggregate functions serve batch and
Structured Streaming frames.
"""

__version__ = "0.1.0"
