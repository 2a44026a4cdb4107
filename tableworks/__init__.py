"""Spark-first table operators: DataFrame in, DataFrame out."""
