"""Month-by-month ingest, validation and insert-only loading of keyed tables on Spark."""
