"""Readers and writers: strict CSV, paged JSON, Parquet, landing of files."""
