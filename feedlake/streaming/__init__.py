"""Structured Streaming form of the changed-since scan."""
