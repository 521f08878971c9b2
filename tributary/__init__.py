"""Table-driven batch analytics on Spark: snapshots, quality rules, star schema."""
