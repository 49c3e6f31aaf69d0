"""Terravane sources."""
