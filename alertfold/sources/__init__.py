"""Readers for folders of delimited exports."""
