"""Spark-first analytics engine for inspection records and text corpora."""
