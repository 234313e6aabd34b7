"""ledgerflow: a metadata-driven banking medallion pipeline on Spark.

Layers: raw extracts / CSV feeds -> bronze (all-string landing) -> silver
(typed, conformed, upserted past a stored high-water mark) -> gold marts ->
report queries.  Everything is DataFrame / Spark SQL / Structured Streaming
code; no Python UDFs and no driver-side collection of bank data.
"""

__version__ = "0.1.0"
