"""Sources and sinks: CSV tables, results files, run logs, stage tables."""
