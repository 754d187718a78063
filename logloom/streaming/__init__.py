"""Structured Streaming form of the log ETL."""
