"""Question-bank migration on Spark DataFrames."""
