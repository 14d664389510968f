"""Table store (keyed parquet tables) and the ingest run with its gates."""
