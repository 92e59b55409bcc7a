"""Registered queries over the test tables, with the SQL each is checked against."""
