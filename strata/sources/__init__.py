"""Sources and sinks: Parquet layers, JDBC, sized and chunked writers."""
