"""Warehouse jobs: dimensions, facts, segmentation, quality suite, reports, incremental loads."""
