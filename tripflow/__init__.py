"""Multi-tenant trip-event ingestion, quality and silver/gold analytics on Spark."""
