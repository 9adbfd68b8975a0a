"""Workforce-compliance, data-quality and trade-stream analytics on Spark."""
