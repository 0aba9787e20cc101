"""Data products: the enriched order table and everything computed from it."""
