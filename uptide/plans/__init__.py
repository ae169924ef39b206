"""Registered queries over the star-schema tables, each next to its SQL counterpart."""
