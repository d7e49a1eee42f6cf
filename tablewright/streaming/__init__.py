"""Incremental materialisation driven by Structured Streaming."""

from tablewright.streaming.materialize import stream_materialize

__all__ = ["stream_materialize"]
