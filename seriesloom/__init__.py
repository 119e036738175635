"""Preparing, linking and publishing large collections of economic time series with Spark.

Every operator is a function from DataFrames to DataFrames over a long table
of observations keyed by ``indicator_id`` and ``timestamp``: one job treats all
series together.
"""
