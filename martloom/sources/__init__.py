"""Readers and writers: raw CSV feeds, driver tables, warehouse tables."""
