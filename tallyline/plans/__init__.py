"""Whole runs and the registered query catalog."""
