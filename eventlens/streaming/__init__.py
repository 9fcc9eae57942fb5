"""Structured Streaming: the incremental, checkpointed load of landed feed files."""
