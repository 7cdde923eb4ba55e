"""Dataflow operators over rasters, features, windows and manifest state."""
