"""Relational operators over page tables (DataFrame in, DataFrame out)."""
