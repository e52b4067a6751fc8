"""Sources (file scans) and sinks (file writers)."""
