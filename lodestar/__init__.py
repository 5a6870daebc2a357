"""lodestar: loading and activating warehouse tables from extracts, on Spark."""

__version__ = "0.1.0"
