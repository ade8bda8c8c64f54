"""End-to-end plans: ingest, incremental views, recorded jobs."""
