"""basketry: a Spark-native commerce data pipeline.

Every operator is a DataFrame -> DataFrame function built from Spark SQL
built-ins, so the same code runs on ``local[*]`` and on a cluster.
"""

__version__ = "0.1.0"
