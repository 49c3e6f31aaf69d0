"""Terravane operators."""
