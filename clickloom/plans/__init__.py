"""Ordered stage runs, the query registry and its SQL counterparts."""
