"""stratum — reusable Spark operators for tables and streams.

Every operator takes and returns a ``pyspark.sql.DataFrame`` and is built
from Spark's own DataFrame / SQL / Structured Streaming / Spark ML
primitives, so Catalyst plans it and Tungsten executes it.
"""

__all__ = ["session"]
