"""Batch retrieval of solved cases for error reports, on Spark DataFrames."""
