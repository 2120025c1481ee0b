"""Ordered-series analytics on Spark: returns, risk, anomaly days, headlines."""
