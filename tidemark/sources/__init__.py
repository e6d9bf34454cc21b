"""Keyed tables of numbered snapshots, and streaming state read as tables."""
