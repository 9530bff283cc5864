"""Corpus fingerprinting as Spark DataFrame transformations."""
