"""Securities market-data lake on Spark: typed tables, incremental loads, deduplicating reads."""

__version__ = "0.1.0"
