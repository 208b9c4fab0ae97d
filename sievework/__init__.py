"""Data-quality gates, warehouse layers and evidence for tables of any size on Spark."""

__version__ = "0.1.0"
