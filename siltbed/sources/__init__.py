"""Readers, landing and capture checks."""
