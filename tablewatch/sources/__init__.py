"""Sources, sinks and the schema catalogue."""
