"""Streaming: incoming drops as a file stream, one published daily run per file."""
