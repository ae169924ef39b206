"""Readers and writers for production, maintenance and stage tables."""
