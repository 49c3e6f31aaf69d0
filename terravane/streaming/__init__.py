"""Terravane streaming."""
