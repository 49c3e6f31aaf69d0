"""Terravane plans."""
