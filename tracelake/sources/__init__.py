"""Sources and sinks: log files, Parquet tables, the file inventory, exports."""
