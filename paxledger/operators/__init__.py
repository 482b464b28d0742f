"""Lookups, joins, aggregates and skew-safe ordered operators."""
