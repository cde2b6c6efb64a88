"""Queries over the sample tables, each with the SQL that states its expected result."""
