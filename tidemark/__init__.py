"""tidemark: e-commerce lakehouse marts, quality checks and churn scoring on Spark SQL.

Operators are plain functions from DataFrames to a DataFrame. Nothing in them starts a job;
the few helpers that do (they publish files or read one scalar) say so.
"""
