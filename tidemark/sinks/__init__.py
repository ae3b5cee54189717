"""Writing: partitioned tables, reports, per-stream results."""
