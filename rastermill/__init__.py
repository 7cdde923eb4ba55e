"""rastermill: training-patch preparation from imagery and labels as Spark dataflows."""

__version__ = "0.1.0"
