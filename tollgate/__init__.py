"""tollgate: access-log bot and seat-hoarding analytics on Spark.

Every operator is a ``DataFrame -> DataFrame`` function (or a Column
builder) expressed with Spark SQL functions, so the same code runs on
batch tables and on Structured Streaming micro-batches.
"""

__version__ = "0.1.0"
