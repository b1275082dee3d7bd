"""Minewright: itemset mining, text, vector, tagging and log analytics as Spark DataFrame jobs."""
