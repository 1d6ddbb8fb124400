"""Scoring and ranking of document collections on Spark."""
