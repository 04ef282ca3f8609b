"""Scans, sinks, validation and the fixture views over the driver tables."""
