"""Web-log analytics on Spark: metrics, anomalies, reports and alerts."""

__version__ = "0.1.0"
