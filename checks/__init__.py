"""Registered queries on inputs derived from the given tables, and the SQL that checks them."""
