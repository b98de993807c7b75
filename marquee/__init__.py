"""Listing pages to clean, deduplicated tables of events, festivals and sports on Spark."""

from marquee.session import checkpoint_dir, configured, local_session

__all__ = ["checkpoint_dir", "configured", "local_session"]
