"""Queries over the given tables, one or more per operator, with their SQL counterparts."""
