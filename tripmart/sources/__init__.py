"""Sources and sinks: files, catalog tables, relational targets."""
