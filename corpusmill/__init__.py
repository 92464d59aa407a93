"""Corpus-processing operators on Spark DataFrames."""
