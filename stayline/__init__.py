"""Churn analytics for subscription products, as Spark DataFrame jobs."""

__version__ = "0.1.0"
