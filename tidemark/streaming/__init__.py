"""The ingest as Structured Streaming jobs over landing directories."""
