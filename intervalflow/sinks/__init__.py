"""Writers for the Hive-partitioned Parquet lake."""
