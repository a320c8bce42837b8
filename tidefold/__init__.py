"""Event analytics on Spark: ingest, identity, upsert folds, document and SQL queries."""
