"""Readers and writers at the edges, and tables written between stages."""
