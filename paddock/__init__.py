"""Racing-data analytics on PySpark: ingestion, point-in-time features, models."""
