"""Retail-bank analytics expressed as lazy Spark DataFrame plans."""

from ledgerloom.catalog import Catalog
from ledgerloom.config import RunContext, Thresholds

__all__ = ["Catalog", "RunContext", "Thresholds"]
