"""Readers and writers: file -> DataFrame, DataFrame -> keyed Parquet."""
