"""Column helpers: conversions, keys, guarded arithmetic and banding rules."""
