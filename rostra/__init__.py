"""Debate-transcript analytics on Spark DataFrames."""
