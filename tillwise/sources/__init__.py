"""Readers: files, tables and per-line records."""
