"""shelfwise: retail data quality, enrichment, return anomalies and recommendations on Spark."""

__version__ = "0.1.0"
