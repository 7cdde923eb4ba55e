"""End-to-end jobs."""
