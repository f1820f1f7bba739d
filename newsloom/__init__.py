"""Spark-native news monitoring: keyed ingestion, relevance, classification and digests."""

from newsloom.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
