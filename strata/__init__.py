"""strata: layered (Bronze / Silver / Gold) survey analytics on Spark.

Wide, coded records arrive as CSV files or JSON messages, are kept unchanged
in a Bronze Parquet layer, refined into Silver (code -> label, decimal
scaling, row validity) and aggregated by key into Gold, joined to a small
reference table for names. Declared quality rules are evaluated as one Spark
aggregation.

Everything is DataFrame / Structured Streaming; there are no UDFs.
"""

from strata.session import get_session, shared_dir

__all__ = ["get_session", "shared_dir"]
