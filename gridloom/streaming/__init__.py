"""Incremental landing of interval files."""
