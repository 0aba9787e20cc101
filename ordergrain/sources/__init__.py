"""Readers, writers and the mapping from the test tables to commerce tables."""
