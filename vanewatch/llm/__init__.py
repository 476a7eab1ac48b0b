"""Operators for preparing training text: mixing, filtering, de-duplication, scoring and packing."""
