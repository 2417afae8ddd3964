"""Structured Streaming: incremental, restartable insert-or-ignore landing of arriving files."""
