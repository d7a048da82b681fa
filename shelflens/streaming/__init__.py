"""Incremental load of the landing folders."""
