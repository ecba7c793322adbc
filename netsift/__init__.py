"""netsift: security-telemetry preparation on Spark.

Flow records and log lines are read as batch tables or streams, parsed into
typed columns, enriched, anonymized through a prefix-preserving mapping table,
scored with TF-IDF, and written out in key order. Every step is a DataFrame
transformation, so batch and Structured Streaming runs share one definition.
"""

__version__ = "0.1.0"
