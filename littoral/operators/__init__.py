"""Operators: spatial join, overlap, merge, and views for checking a result."""
