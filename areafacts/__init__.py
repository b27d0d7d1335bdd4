"""Per-area facts (zip codes and counties) as plain Spark DataFrame jobs.

Nothing runs at import: every function takes a DataFrame (or a session and a
path) and returns a DataFrame, except the explicit sinks in ``sources``.
"""
