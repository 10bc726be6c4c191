"""Writers: partitioned Parquet, logs, and file maintenance."""
