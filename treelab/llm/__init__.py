"""Operators for cleaning, mixing and encoding large text corpora."""
