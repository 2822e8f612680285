"""Size checks, lineage cuts and end-to-end jobs."""
