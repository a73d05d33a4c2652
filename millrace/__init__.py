"""Millrace: curation analytics on Spark DataFrames."""
