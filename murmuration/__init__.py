"""Time-bucketed, confidence-scored signals from short social posts, on Spark."""
