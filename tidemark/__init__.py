"""Indicator lakehouse jobs as plain Spark DataFrame functions."""
