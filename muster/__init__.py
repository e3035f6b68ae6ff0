"""Workforce analytics expressed as Spark DataFrames."""
