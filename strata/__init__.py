"""Layered batch data work on Spark: delimited text to enriched, partitioned tables."""
