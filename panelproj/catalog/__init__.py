"""Example data views and the registered queries with their SQL counterparts."""
