"""Checks against a second engine: views over the test tables, registered queries and their SQL."""
