"""Growing datasets."""
