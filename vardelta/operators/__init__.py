"""Joins, aggregations, windows and composite jobs over variant tables."""
