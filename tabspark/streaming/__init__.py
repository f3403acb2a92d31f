"""Structured Streaming: minute activity, duplicates, gaps. Batch and stream share the expressions."""
