"""Sources: parquet scans, the star-schema fixture and the order generator."""
