"""strata: layered (raw / silver / gold) table analytics on Spark.

Every public operator is a pure ``DataFrame -> DataFrame`` function built from
native Spark expressions. The caller owns the ``SparkSession``; the library never
creates one.
"""

__version__ = "0.1.0"
