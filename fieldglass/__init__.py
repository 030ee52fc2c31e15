"""Profiling, feature engineering, time-series and model comparison on Spark DataFrames."""
