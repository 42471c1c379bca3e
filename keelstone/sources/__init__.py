"""Readers: multi-file extracts, delimited text, Parquet and label dictionaries."""
