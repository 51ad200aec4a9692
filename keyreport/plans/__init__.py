"""Registered queries over the driver's tables (``catalog``) and the
reference's report families over delimited inputs (``reports``)."""
