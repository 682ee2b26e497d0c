"""Payment-event analytics on Spark: bronze ingestion, a quality gate, and
DataFrame operators for profiling, routing checks, deduplication and rollups."""
