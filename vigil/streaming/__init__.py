"""Structured Streaming entry points (incremental builds)."""
from vigil.streaming.incremental import incident_stream, start_incident_sink  # noqa: F401
