"""Structured Streaming: transaction buffering and the two pipelines."""
