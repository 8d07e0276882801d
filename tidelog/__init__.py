"""Event-log tables on Spark: positions, lag, delivery, retention, schemas, streams."""
