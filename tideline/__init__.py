"""tideline — a retail real-time warehouse expressed as Spark DataFrame jobs.

Every transformation is a ``DataFrame -> DataFrame`` function so the same body
serves a batch query over parquet tables and a Structured Streaming
``foreachBatch`` callback.
"""

__all__ = ["session"]
