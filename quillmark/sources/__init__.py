"""Sources and sinks: Parquet, JSON lines, tab-separated counts, streams, models."""
