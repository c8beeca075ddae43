"""Batch ratings lakehouse on Spark: delimited bronze, Parquet silver, CSV gold."""
