"""Staging, marts and analyses as functions from DataFrames to DataFrames."""
