"""Terravane functions."""
