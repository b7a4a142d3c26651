"""Registered queries over the driver's tables, and the SQL that gives the same results."""
