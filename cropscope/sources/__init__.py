"""Sources and sinks: test-table bindings, file listings, CSV, Parquet output."""
