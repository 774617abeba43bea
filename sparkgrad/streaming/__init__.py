"""Scoring and training on streams."""
