"""Layered build, metric layer, business questions and quality checks."""
