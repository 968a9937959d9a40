"""Inputs derived from the test tables, and the SQL every query is checked against."""
