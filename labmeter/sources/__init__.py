"""Table schemas, readers, sinks, and views over the sample tables."""
