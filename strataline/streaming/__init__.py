"""Variants for streams."""
