"""Scalar functions over typed values and their texts."""
