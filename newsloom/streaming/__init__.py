"""The hourly job as streams: keyed appends, bounded deduplication and windowed counts."""
