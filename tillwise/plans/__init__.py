"""Whole jobs: retail sales, clickstream, customers, employees, reports."""
