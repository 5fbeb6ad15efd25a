"""Readers of the exports and the Bronze tables."""
