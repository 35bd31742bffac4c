"""Batch analytics over relation records, property graphs and cell tables, on Spark DataFrames."""
