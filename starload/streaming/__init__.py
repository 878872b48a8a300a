"""Incremental loads: landed payload files picked up by Structured Streaming."""
