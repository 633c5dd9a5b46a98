"""Incremental processing of read chunks as they arrive."""
