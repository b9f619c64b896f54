"""Repeated micro-loads as Structured Streaming file sources."""

from riskmesh.streaming.micro_loads import latest_load, micro_load  # noqa: F401
