"""Column functions with the null, rounding and naming rules of the telemetry domain."""
