"""Named queries over the driver tables, and the same queries as DuckDB SQL."""
