"""Sources and sinks: delimited and archive scans, slot tables, results."""
