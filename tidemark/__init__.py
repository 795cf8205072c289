"""Tidemark: trend analytics over panels of daily series, on Spark DataFrames.

Long event tables go in; gap-free daily series per key, engineered features,
forecasts with intervals, holdout scores, risk tiers, prompts and report
tables come out. Every operator is a function from DataFrames to a DataFrame.
"""

__version__ = "0.1.0"
