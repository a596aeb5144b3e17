"""churnlab: subscriber-churn analytics on Spark DataFrames.

Every operator takes and returns a ``pyspark.sql.DataFrame``; fitted state is a
one-row DataFrame or an MLlib model. Nothing is collected to the driver except
bounded metadata (vocabularies, a handful of fitted statistics).
"""

__version__ = "0.1.0"
