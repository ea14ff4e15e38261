"""Incremental form of the recurring clickstream load."""
