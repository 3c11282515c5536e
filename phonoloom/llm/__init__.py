"""Operators on texts for language models. Nothing outside this package imports it."""
