"""Incremental processing with Structured Streaming."""

from refinery.streaming.new_folders import refine_new_landings

__all__ = ["refine_new_landings"]
