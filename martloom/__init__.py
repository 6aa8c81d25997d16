"""Retail star-schema warehouse jobs written with the Spark DataFrame API."""
