"""Incremental reports over a folder that order files keep landing in."""
