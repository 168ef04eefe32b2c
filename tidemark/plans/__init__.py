"""Queries over the test tables and the SQL that checks them."""
