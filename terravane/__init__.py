"""Terravane: geo-temporal evidence analytics written as Spark DataFrame jobs."""
