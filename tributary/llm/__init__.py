"""Operators for cleaning and scoring large text corpora."""
