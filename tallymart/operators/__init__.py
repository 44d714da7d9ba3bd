"""Analyses, data-quality audit and pre-flight checks."""
