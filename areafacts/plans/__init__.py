"""Feeds (raw file to clean table) and marts (queries over the tables)."""
