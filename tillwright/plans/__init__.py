"""Layers put together, the registered queries, and the SQL they are checked against."""
