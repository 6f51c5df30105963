"""revcast: forecast revision history and accuracy scoring on Spark."""

__version__ = "0.1.0"
