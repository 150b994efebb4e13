"""Operators over DataFrames: deduplicate, shape, join, limit, check."""
