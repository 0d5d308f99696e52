"""Sinks: keyed upsert table, model persistence."""
