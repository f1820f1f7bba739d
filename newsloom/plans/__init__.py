"""Composed jobs: feed ingestion, classification and digests."""
