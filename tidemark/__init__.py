"""Keyed, snapshot-versioned tables and inspectable streaming state on Spark."""
