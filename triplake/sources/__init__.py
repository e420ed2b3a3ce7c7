"""Scans, sinks, period discovery and the adapter that turns the driver tables into trip tables."""
