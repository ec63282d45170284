"""Composite jobs and the query catalog over the corpus tables."""
