"""Reading raw files and keeping Parquet tables."""
