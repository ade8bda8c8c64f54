"""File streams: resumable directory ingest and recurring view refresh."""
