"""Sources and sinks: table scans, derived fixtures, files, JDBC."""
