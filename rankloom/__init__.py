"""Ranking analytics as PySpark DataFrame operators and pyspark.ml stages."""
