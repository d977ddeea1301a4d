"""File layouts, scans, loads and sinks."""
