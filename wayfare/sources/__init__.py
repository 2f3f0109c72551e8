"""Sources and sinks: typed readers, test-table adapters, writers."""
