"""transitlens: live vehicle positions from arrival predictions, on Spark.

Batch and Structured Streaming share the same DataFrame -> DataFrame
functions. Everything runs as built-in Spark SQL expressions; there is no
Python UDF anywhere in the package.
"""

__all__ = ["session", "schemas"]
