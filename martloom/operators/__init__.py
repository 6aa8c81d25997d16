"""Reusable DataFrame operators: keys, lookups, versioning, profiling and quality checks."""
