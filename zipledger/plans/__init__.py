"""Composite jobs and the registered query catalog."""
