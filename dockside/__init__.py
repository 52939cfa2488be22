"""On-time delivery analytics as Spark DataFrame operators and reports."""
