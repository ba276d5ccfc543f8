"""Registered queries over the test tables."""

from registered import batch, metadata, naming, transfer
from registered.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "batch", "metadata", "naming", "transfer"]
