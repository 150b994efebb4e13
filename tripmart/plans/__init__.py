"""Staged tables, marts and the build over them."""
