"""Streams into and out of keyed tables, and keyed state of streams."""
