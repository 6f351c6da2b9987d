"""Multi-step jobs: the resumable ingest and the query catalogue."""
