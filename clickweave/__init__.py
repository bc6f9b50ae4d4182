"""clickweave — web-event analytics on Spark.

Raw JSON events → validated, enriched, session-sequenced Parquet table →
library of DataFrame queries. See README.md.
"""

__version__ = "0.1.0"
