"""Metadata-driven ingestion, transformation and data quality as Spark DataFrame functions.

Every operator takes DataFrames and parameters and returns a DataFrame.
"""
