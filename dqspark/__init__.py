"""Data quality and statistics of tabular data on Spark."""
