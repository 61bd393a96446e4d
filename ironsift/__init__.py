"""Corpus triage operators on Spark DataFrames."""
