"""Readers for the lake, landed feeds and relational tables."""
