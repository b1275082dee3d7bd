"""Registered queries over the test tables, each beside the SQL that checks it."""

from minewright.catalog import itemsets, logs, tagging, topics, vectors, words
from minewright.catalog.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES", "itemsets", "logs", "tagging", "topics", "vectors", "words"]
