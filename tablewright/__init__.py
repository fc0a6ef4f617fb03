"""Supervised learning on tables with Spark SQL and ``pyspark.ml``.

Every operator is a plain function from DataFrame to DataFrame (or from
DataFrame to a fitted ``pyspark.ml`` model).  Nothing runs row by row in Python.
"""
