"""Writers: Parquet folders and catalog tables."""
