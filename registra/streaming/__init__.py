"""Repeated mart runs fed by newly arriving log files."""
