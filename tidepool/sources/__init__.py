"""Sources and sinks: test tables, the sensor feed, Parquet tables."""
