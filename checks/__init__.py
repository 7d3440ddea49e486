"""Queries over the star-schema test tables and the SQL they are compared with."""
