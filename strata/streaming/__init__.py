"""Streams between layers."""
