"""Compositions of operators: the whole analysis, its stages, and checked queries."""
