"""Corpus-preparation operators. Nothing outside this package imports it."""
