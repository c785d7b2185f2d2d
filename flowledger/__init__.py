"""Session-record analytics on Spark: parse raw session logs, keep rollups, answer reports."""
