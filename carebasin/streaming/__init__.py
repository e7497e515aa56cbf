"""Incremental file loading."""
