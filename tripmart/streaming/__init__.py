"""Incremental loads."""

from tripmart.streaming.promote import promote_available

__all__ = ["promote_available"]
