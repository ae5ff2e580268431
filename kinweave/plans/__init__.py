"""Whole runs over the operators, and the queries over the test tables."""
