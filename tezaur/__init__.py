"""Corpus and tabular analytics declared on Spark DataFrames."""
