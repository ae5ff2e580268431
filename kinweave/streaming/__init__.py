"""Candidate generation over arriving batches of queries."""
