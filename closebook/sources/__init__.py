"""Readers for processor files and report tables."""
