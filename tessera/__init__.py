"""tessera: the ticket pipeline on Spark.

Messages are parsed and routed by a Structured Streaming job, exported as
Parquet and JSON, then cleaned, profiled, counted and loaded by batch jobs.
Every step is a DataFrame-to-DataFrame function built from Spark's own
functions, so batch and streaming share the code.
"""

__version__ = "0.1.0"
