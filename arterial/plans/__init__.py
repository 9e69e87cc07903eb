"""Adapter views over the given tables, the query catalogue and its SQL counterparts."""
