"""Folia: structured-document operators on Spark DataFrames."""
