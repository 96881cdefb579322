"""Queries over the supplied test tables, each with the SQL that must give the same rows."""
