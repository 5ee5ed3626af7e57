"""Keyed sensor-stream analytics on Spark."""
