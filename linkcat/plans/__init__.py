"""Registered queries over the benchmark tables and the SQL they must equal."""
