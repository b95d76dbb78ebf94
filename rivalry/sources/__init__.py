"""Readers and writers. Parquet is the contract between stages."""
