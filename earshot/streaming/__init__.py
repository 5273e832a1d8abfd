"""Event enrichment and the Structured Streaming jobs around it."""
