"""Operators for preparing training text at scale: scoring, packing, search, filters."""
