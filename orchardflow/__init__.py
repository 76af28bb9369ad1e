"""Catalogue-page data quality on Spark DataFrames."""
