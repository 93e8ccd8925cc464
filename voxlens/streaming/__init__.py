"""Structured Streaming ingestion of feedback batches."""
