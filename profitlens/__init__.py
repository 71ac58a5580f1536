"""Profitability analytics over order-item tables, written as Spark DataFrame jobs."""

from profitlens.config import Thresholds

__all__ = ["Thresholds"]
