"""Whole jobs: read, work, write, report."""
