"""The composite jobs: refresh run, wide-index ingest, dashboard queries."""
