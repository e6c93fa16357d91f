"""Incremental landing of new files."""

from kerbside.streaming.landing import land_new_files

__all__ = ["land_new_files"]
