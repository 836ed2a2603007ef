"""Repeatable loads and streaming twins."""
