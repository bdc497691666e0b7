"""Sources and sinks: header CSV, JSON message topics, Parquet tables, reports."""
