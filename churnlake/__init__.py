"""churnlake — customer-retention analytics as Spark DataFrame jobs.

Every job is a ``DataFrame -> DataFrame`` function built on the DataFrame
API, Spark SQL, Structured Streaming and ``pyspark.ml``.  No Python UDF runs
in any hot path; the few places that need per-group logic use Arrow-batched
pandas functions over Spark-partitioned data.
"""

__version__ = "0.1.0"
