"""Reusable operators over long-format telemetry."""
