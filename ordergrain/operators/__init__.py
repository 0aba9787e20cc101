"""Operators built from DataFrame operations that Spark does not offer directly."""
