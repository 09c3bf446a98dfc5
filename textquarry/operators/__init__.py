"""Relational operators: joins, duplicates, components, splits, proofs."""
