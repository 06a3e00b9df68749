"""Retail analytics on Spark DataFrames: staging, marts, incremental orders, checks."""
