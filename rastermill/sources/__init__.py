"""Readers and writers of rasters, vectors, catalog items, shards and indexes."""
