"""Readers for files, JSON lines and compressed frames."""
