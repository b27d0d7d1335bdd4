"""Readers for the feed files and sinks for the keyed tables."""
