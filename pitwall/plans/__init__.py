"""Registered queries over the shared tables, with their SQL twins."""
