"""Operators for building language-model training data: de-duplication, encoding, packing, scoring."""
