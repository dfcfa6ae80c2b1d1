"""Plumbline: data quality and observability for batch tables, written on Spark DataFrames."""
