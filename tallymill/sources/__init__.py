"""Bronze scans, table sinks and the load log."""
