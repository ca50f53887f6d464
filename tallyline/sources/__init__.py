"""Sources and sinks: CSV files, file inventory, the test tables, generated rows."""
