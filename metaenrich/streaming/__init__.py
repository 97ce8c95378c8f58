"""Streaming front end."""
