"""Structured Streaming forms of the daily restriction tables (T5)."""

from .restrictions import read_block_restriction, start_restriction_stream

__all__ = ["start_restriction_stream", "read_block_restriction"]
