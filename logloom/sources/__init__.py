"""Readers for raw logs and for stored metric tables."""
