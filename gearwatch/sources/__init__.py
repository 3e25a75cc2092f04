"""Sources: dimension tables, the telemetry view of the given tables, synthetic data, topics."""
