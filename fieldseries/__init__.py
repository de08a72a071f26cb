"""Sensor time-series engine on Spark."""
