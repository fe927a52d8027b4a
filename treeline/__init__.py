"""Treeline: verifiable, cumulative data releases on Spark DataFrames."""
