"""statmart: sports-player statistics on Spark (ingest, models, dashboard queries)."""

__version__ = "0.1.0"
