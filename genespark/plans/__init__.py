"""Composed plans and the catalogue of named queries."""
