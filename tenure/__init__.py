"""Subscription revenue and retention jobs on Spark.

Every job is a function from DataFrames (and an explicit as-of date) to a DataFrame.
Reading and writing live in ``tenure.sources`` only.
"""
