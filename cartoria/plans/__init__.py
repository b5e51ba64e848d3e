"""Whole queries, composed of the operators, and the SQL they are checked against."""
